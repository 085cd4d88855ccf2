"""History operators: build, merge, classify, privacy, reload, report, views."""
