"""Literal tokens that every match of a regular expression must hold.

A token is a run of ASCII letters and digits between separators or the ends of
the text.  A run of the pattern is forced if it stands in the pattern's main
sequence with a separator or an end of the text on both sides; whatever is
uncertain beside it (open sets, look-around, alternatives, syntax that is not
understood) makes it not forced, so the result may miss tokens but never holds
one that a match could do without.
"""

from __future__ import annotations

import re
import warnings
from re import _constants as op
from re import _parser as parser

_EDGE, _OPEN = "edge", "open"  # certainly a separator or an end; anything


def _char(code: int) -> str:
    if code > 127:
        return _OPEN
    return chr(code).lower() if chr(code).isalnum() else _EDGE


def _separators(members) -> bool:
    """Whether a set holds ASCII separators only."""
    for kind, x in members:
        if kind is op.RANGE:
            codes = range(x[0], min(x[1], 128) + 1)
        elif kind is op.LITERAL:
            codes = (x,)
        else:
            return False
        if any(_char(c) != _EDGE for c in codes):
            return False
    return True


def _elements(sequence) -> list[str]:
    out: list[str] = []
    for kind, x in sequence:
        if kind is op.LITERAL:
            out.append(_char(x))
        elif kind is op.AT and x in (op.AT_BEGINNING, op.AT_BEGINNING_STRING, op.AT_END, op.AT_END_STRING):
            out.append(_EDGE)
        elif kind is op.IN:
            out.append(_EDGE if _separators(x) else _OPEN)
        elif kind is op.SUBPATTERN:
            out += _elements(x[3])
        elif kind is op.BRANCH:
            out.append(_EDGE if all(_elements(s) == [_EDGE] for s in x[1]) else _OPEN)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, _, repeated = x
            inner = _elements(repeated)
            # left out or ending in a separator: what follows an edge still follows one
            after_edge = out[-1:] == [_EDGE] and inner[-1:] == [_EDGE]
            out.append(_EDGE if after_edge or (least and inner == [_EDGE]) else _OPEN)
        else:
            out.append(_OPEN)
    return out


def forced_tokens(pattern: str) -> list[str]:
    """The forced tokens of ``pattern``, lower-cased, in their order; none for
    syntax that is not understood."""
    # set operations are read otherwise elsewhere; by Unicode case an ASCII letter fits others
    if re.search(r"&&|\[[^\]]*\[|\(\?[A-Za-z]*u", pattern):
        return []
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            elements = [_OPEN, *_elements(parser.parse(pattern)), _OPEN]
    except (re.error, OverflowError, RecursionError):
        return []
    found, run, bounded = [], "", False
    for e in elements:
        if len(e) == 1:
            run += e
            continue
        if run and bounded and e == _EDGE:
            found.append(run)
        run, bounded = "", e == _EDGE
    return list(dict.fromkeys(found))
