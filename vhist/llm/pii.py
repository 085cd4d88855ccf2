"""Personal data: generators propose spans, boosted trees choose among them.

Everything here is DataFrame functions.  Strict generators, one per kind, give
the base spans: leftmost non-overlapping matches, failing ones dropped, the
others always kept.  Loose generators propose more spans (numbers that the
strict pattern joined with digits beside them, national phone numbers,
addresses written with "at" and "dot", cards with other separators, IPv6).  Format and context of every candidate become small binned features;
the trees learn from the corpus which candidates pass their kind's validation,
from all documents' candidates aggregated into feature cells, and a threshold
calibrated on a fifth of the documents decides on the loose ones.  A loose span
that overlaps a base span is not added.

Offsets are code points, ends exclusive.  The patterns use possessive
quantifiers and look-behind, which match the same text as the plain ones but
need neither recursion nor quadratic time on long runs.

Defined cases: null and empty texts have no span; repeated rows give a row
each; a corpus without failing (or without passing) candidates adds no span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vhist.llm import boosting
from vhist.llm.common import written

# Kinds in their listed order.
KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.95
CONTEXT = 24  # characters on either side that the features see

_LOCAL = "A-Za-z0-9._%+-"
BASE_PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Kind, pattern, and a cheap test that any match passes.
LOOSE_PATTERNS = [
    ("email", rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+ ?(?:\[at\]|\(at\)|\{{at\}}) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\{{dot\}}|\.) ?[A-Za-z0-9-]++){{1,8}}+", r"[\[({]at[\])}]"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", "[0-9]"),
    # a number that the strict pattern joined with digits beside it
    ("card", r"(?<![0-9])[0-9]{12,19}+(?![0-9])", "[0-9]{12}"),
    ("card", r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){11,18}+(?![0-9])", "[0-9]"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])", r"\+[0-9]"),
    ("phone", r"(?<![0-9+])\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,4}){2,4}+(?![0-9])", "[0-9]"),
]
# What any match of a strict pattern holds.
_MAY = {"email": "@", "ip": ".", "phone": "+"}
_WORDS = r"(?i)(mail|contact|kontakt|correo|courriel|phone|tel|call|fax|mobil|card|visa|carte|karte|tarjeta|host|server|address|ip)\W{0,4}$"

FEATURES = ["kind_no", "loose", "digits", "breaks", "size", "luhn", "before", "after", "cue"]


def _found(text: Column, kind: str, generator: int, pattern: str, may: Column) -> Column:
    """Array of (kind_no, loose, i, gap, span, left, right) in order of place;
    ``loose`` is the generator's number, 0 for the strict one."""
    spans, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, F.lit(pattern))
    rows = F.transform(
        F.arrays_zip(spans.alias("span"), F.slice(gaps, 1, F.size(spans)).alias("left"), F.slice(gaps, 2, F.size(spans)).alias("right")),
        lambda x, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(generator).alias("loose"), i.alias("i"), F.length(x["left"]).alias("gap"), x["span"].alias("span"),
            F.right(x["left"], F.lit(CONTEXT)).alias("left"), F.left(x["right"], F.lit(CONTEXT)).alias("right"),
        ),
    )
    none = F.array().cast("array<struct<kind_no:int,loose:int,i:int,gap:int,span:string,left:string,right:string>>")
    return F.when(may, rows).otherwise(none)


def _generated(text: Column) -> Column:
    """The spans of all generators."""
    digit = text.rlike("[0-9]")
    strict = [(k, 0, p, F.contains(text, F.lit(_MAY[k])) & (digit if k != "email" else F.lit(True)) if k in _MAY else digit) for k, p in BASE_PATTERNS.items()]
    loose = [(k, n + 1, p, text.rlike(test)) for n, (k, p, test) in enumerate(LOOSE_PATTERNS)]
    return F.concat(*[_found(text, *g) for g in strict + loose])


def candidates(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row per candidate span (and one, without span, per document that has
    none): row_id, doc_id, text_key, kind_no, loose, start, end, valid, features."""
    text = F.coalesce(documents["text"].cast("string"), F.lit(""))
    docs = documents.select(documents[id_col].cast("long").alias("doc_id"), text.alias("text")).withColumn("row_id", F.monotonically_increasing_id())
    rows = docs.select("row_id", "doc_id", F.xxhash64("text").alias("text_key"), F.explode_outer(_generated(F.col("text"))).alias("x")).select("row_id", "doc_id", "text_key", "x.*")
    # offsets: what stands before a span of its generator, by a running sum in the document
    before = Window.partitionBy("row_id", "kind_no", "loose").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("span")
    end = F.sum(F.col("gap") + size).over(before)
    digits = F.regexp_replace("span", "[^0-9]", "")
    n = F.length(digits)
    part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    luhn = (n >= 12) & (n <= 19) & F.call_function("luhn_check", digits)
    valid = (
        F.when(F.col("kind_no") == 0, (F.col("loose") == 0) | F.col("span").rlike(r"[A-Za-z]{2,}$"))
        .when(F.col("kind_no") == 1, F.when(F.col("loose") == 0, F.col("span").rlike(rf"^{part}\.{part}\.{part}\.{part}$")).otherwise(F.lit(True)))
        .when(F.col("kind_no") == 2, luhn)
        .otherwise((n >= 9) & (n <= 15))
    )
    kind_of_char = lambda c: (
        F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike("^[A-Za-z]"), 3).when(c.rlike(r"^[.,;:!?)(\"']"), 4).otherwise(5)
    )
    rows = rows.repartition("row_id").withColumn("end", end).withColumn("start", F.col("end") - size)
    return rows.select(
        "row_id", "doc_id", "text_key", "kind_no", "loose", "start", "end", valid.alias("valid"),
        F.least(F.floor(n / 3), F.lit(7)).cast("int").alias("digits"),
        F.least(F.length(F.regexp_replace("span", "[A-Za-z0-9]", "")), F.lit(5)).alias("breaks"),
        F.least(F.floor(size / 6), F.lit(6)).cast("int").alias("size"),
        F.coalesce(luhn, F.lit(False)).cast("int").alias("luhn"),
        kind_of_char(F.right("left", F.lit(1))).alias("before"),
        kind_of_char(F.left("right", F.lit(1))).alias("after"),
        F.col("left").rlike(_WORDS).cast("int").alias("cue"),
    )


def fit(rows: DataFrame, precision: float = PRECISION):
    """(model, threshold) from all candidates, aggregated into feature cells."""
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    # a loose span that fails and the strict ones that pass or fail are evidence; a loose one that passes is what is to be judged
    known = rows.filter(F.col("kind_no").isNotNull() & ((F.col("loose") == 0) | ~F.col("valid")))
    cells = known.groupBy(*FEATURES).agg(
        F.sum(F.when(F.col("valid") & ~calibrates, 1).otherwise(0)).alias("p"), F.sum(F.when(~F.col("valid") & ~calibrates, 1).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("valid") & calibrates, 1).otherwise(0)).alias("cp"), F.sum(F.when(~F.col("valid") & calibrates, 1).otherwise(0)).alias("cn"),
    ).collect()  # bounded by the product of the features' bins
    # whether a generator is loose tells the label apart by construction, so the trees do not see it
    x = lambda r: tuple(r[f] for f in FEATURES if f != "loose")
    model = boosting.fit([(x(r), r.p, r.n) for r in cells])
    return model, boosting.threshold(model, [(x(r), r.cp, r.cn) for r in cells], precision)


def chosen_spans(rows: DataFrame, precision: float = PRECISION) -> DataFrame:
    """The candidates that stay, with ``base``; a document without any keeps a row of nulls."""
    model, least = fit(rows, precision)
    score = boosting.expression(model, [f for f in FEATURES if f != "loose"])
    base = (F.col("loose") == 0) & F.col("valid")
    # spans equal to a base span come from both generators; the overlap test drops them with the rest
    row = Window.partitionBy("row_id").orderBy("start", "end")
    marked = rows.withColumn("base", F.coalesce(base, F.lit(False)))
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(row.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(row.rowsBetween(1, Window.unboundedFollowing))
    marked = marked.withColumn("reach", reach).withColumn("ahead", ahead)
    clear = (F.coalesce("reach", F.lit(-1)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end"))
    added = (F.col("loose") > 0) & F.col("valid") & clear & (score >= least) if least != float("inf") else F.lit(False)
    return marked.withColumn("added", F.coalesce(added, F.lit(False)))


def _joined(condition: Column) -> Column:
    """The spans under a condition as kind:start:end by start, then kind."""
    spans = F.array_sort(F.array_distinct(F.collect_list(F.when(condition, F.struct("start", "kind_no", "end")))))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def personal_data(documents: DataFrame, precision: float = PRECISION, id_col: str = "doc_id") -> DataFrame:
    """One row per document: base counts and digest, and all spans."""
    spans = chosen_spans(written(candidates(documents, id_col), "spans"), precision)
    count = lambda k: F.count(F.when(F.col("base") & (F.col("kind_no") == KINDS.index(k)), 1)).alias(f"n_{k}")
    per = spans.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"), *[count(k) for k in KINDS], _joined(F.col("base")).alias("base"), _joined(F.col("base") | F.col("added")).alias("spans")
    )
    return per.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def redact(documents: DataFrame, precision: float = PRECISION) -> DataFrame:
    """The documents with every chosen span replaced by its kind in brackets
    (overlapping spans as one, under the first's kind); other columns stay."""
    spans = chosen_spans(written(candidates(documents), "spans"), precision).filter(F.col("base") | F.col("added"))
    # overlapping spans join into one run
    order = Window.partitionBy("row_id").orderBy("start", "kind_no", "end")
    fresh = F.col("start") >= F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = spans.withColumn("run", F.sum(F.when(fresh, 1).otherwise(0)).over(order)).groupBy("row_id", "run").agg(
        F.first("doc_id").alias("d"), F.first("text_key").alias("t"), F.min("start").alias("s"), F.max("end").alias("e"), F.min(F.struct("start", "kind_no")).alias("k"),
    )
    # repeated rows hold the same spans, so one of each (doc_id, text) suffices
    per = runs.groupBy("row_id").agg(F.first("d").alias("d"), F.first("t").alias("t"), F.array_sort(F.collect_list(F.struct("s", "e", "k.kind_no"))).alias("runs"))
    per = per.dropDuplicates(["d", "t"]).drop("row_id")
    # the documents' own columns travel in a struct, whatever their names are
    whole = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    key = F.xxhash64(whole(documents["text"])).alias("key")
    docs = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("doc"), documents["doc_id"].cast("long").alias("id"), key)
    joined = docs.join(per, F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("t")), "left").withColumn("whole", whole(F.col("doc.text")))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("runs", i - 1)["e"]).cast("int")
    pieces = F.transform("runs", lambda r, i: F.concat(F.col("whole").substr(before(i) + 1, r["s"].cast("int") - before(i)), F.get(marks, r["kind_no"])))
    tail = F.expr("substring(whole, cast(element_at(runs, -1).e as int) + 1)")
    redacted = F.when(F.col("runs").isNull(), F.col("doc.text")).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return joined.select(*[redacted.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in documents.columns])
