"""Write QUERIES.md: every registered key with its SURVEY section, the
operator function(s) its plan calls and how it is checked."""

from __future__ import annotations

import inspect
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

def main() -> None:
    from postlens.plans import catalog
    entries = catalog.load_all()
    out = ["# Registered queries", "",
           "Generated by `tools/query_index.py`. Every key of SURVEY §2 is registered in "
           "`__spark_entry__.queries()`; *oracle* keys also have a DuckDB statement in `oracle_sql()` that "
           "returns the same rows, *bounds* keys (models) are checked in `tests/test_models.py`.", "",
           "| Key | § | Check | Operators called |", "| --- | --- | --- | --- |"]
    for key, e in entries.items():
        src = inspect.getsource(e.fn)
        calls = []
        for alias, name in re.findall(r"\b([A-Za-z]+)\.([a-z_][a-z_0-9]*)\(", src):
            mod = e.fn.__globals__.get(alias)  # the module that the plan calls by this name
            if inspect.ismodule(mod) and mod.__name__.startswith("postlens."):
                ref = f"`{mod.__name__.removeprefix('postlens.')}.{name}`"
                if ref not in calls:
                    calls.append(ref)
        check = "oracle" if e.oracle else "bounds"
        out.append(f"| `{key}` | {e.section} | {check} | {', '.join(calls) or '(plan module)'} |")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "QUERIES.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(f"wrote {path} ({len(entries)} keys)")


if __name__ == "__main__":
    main()
