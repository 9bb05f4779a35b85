"""python -m tessitura QUERY TABLES OUT: run a query of the catalogue over a folder of tables and write its rows."""

from __future__ import annotations

import argparse

from tessitura.plans import catalogue
from tessitura.session import session


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessitura", description=__doc__)
    parser.add_argument("query", choices=sorted(catalogue.QUERIES))
    parser.add_argument("tables", help="folder or URI with one Parquet table for each name")
    parser.add_argument("out", help="folder or URI to write to; it is replaced")
    parser.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    parser.add_argument("--explain", action="store_true", help="print the plan and write nothing")
    got = parser.parse_args(args)
    found = catalogue.QUERIES[got.query](session(), got.tables)
    if got.explain:
        found.explain("formatted")
        return
    writer = found.write.mode("overwrite").format(got.format)
    (writer.option("header", True) if got.format == "csv" else writer).save(got.out)


if __name__ == "__main__":
    main()
