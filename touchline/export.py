"""Export every catalogue result as delimited text, one folder per key.

``python -m touchline.export <sf_dir> <out_dir> [key ...]`` runs the
questions and writes each result with ``;`` and a header (decimal points,
empty for NULL) under ``<out_dir>/<key>/``.  Results are written by their
own tasks, never gathered into one file or brought to the driver; a result
that must be read in order carries its ordering columns.
"""

from __future__ import annotations

import sys


def export_all(spark, sf_dir: str, out_dir: str, keys=None) -> dict[str, str]:
    from touchline.plans import QUERIES
    from touchline.sources.delimited import Field, write_delimited

    paths = {}
    for key in keys or list(QUERIES):
        path = f"{out_dir.rstrip('/')}/{key}"
        result = QUERIES[key](spark, sf_dir)
        write_delimited(result, path, [Field(c, c) for c in result.columns], bom=False)
        paths[key] = path
    return paths


def main(argv: list[str]) -> int:
    from touchline.session import local_session

    if len(argv) < 2:
        print("usage: python -m touchline.export <sf_dir> <out_dir> [key ...]", file=sys.stderr)
        return 2
    spark = local_session()
    for key, path in export_all(spark, argv[0], argv[1], argv[2:] or None).items():
        print(f"{key}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
