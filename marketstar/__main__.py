"""``python -m marketstar --sf-dir DIR --schema NAME [--location PATH]``: run the load job."""

from __future__ import annotations

import argparse
import json

from .plans import job
from .session import build_session, scratch_path


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="marketstar", description="Publish the star schema and its views.")
    ap.add_argument("--sf-dir", required=True, help="folder with the driver parquet tables")
    ap.add_argument("--schema", default="market", help="catalog schema to publish into")
    ap.add_argument("--location", default=None, help="shared folder for the tables (default: under spark.checkpoint.dir)")
    ap.add_argument("--master", default=None, help="only to override the master of spark-submit")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    location = args.location or scratch_path(spark, f"{args.schema}_tables")
    report = job.run(spark, args.sf_dir, args.schema, location)
    print(json.dumps({"schema": args.schema, "location": location, "rows": report}))
    spark.stop()


if __name__ == "__main__":
    main()
