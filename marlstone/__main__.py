"""python -m marlstone: ingest one file, or watch a folder.

The recogniser and the hashes are named as module:function; thresholds come
from spark.marlstone.* keys of the session.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from . import logs
from .options import Options
from .plans import ingest
from .streaming import watcher


def named(path: str):
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="marlstone", description=__doc__)
    p.add_argument("what", choices=("ingest", "watch"))
    p.add_argument("path", help="a file, or the folder to watch")
    p.add_argument("root", help="folder of the results")
    p.add_argument("--recogniser", required=True, help="module:function that makes a client")
    p.add_argument("--hashes", required=True, help="module:function that adds sig, img_w and img_h")
    p.add_argument("--render", help="module:function that gives a PDF's pages as images")
    p.add_argument("--once", action="store_true", help="watch: stop when all present files are done")
    p.add_argument("--archive", help="watch: folder that ingested files move to")
    a = p.parse_args(argv)
    logs.configure()
    spark = SparkSession.builder.appName("marlstone").getOrCreate()
    more = {"render": named(a.render)} if a.render else {}
    parts = (spark, a.path, a.root, named(a.recogniser), named(a.hashes), Options.from_conf(spark))
    if a.what == "ingest":
        return 0 if ingest.ingest_file(*parts, **more) else 1
    watcher.watch(*parts, available_now=a.once, archive_to=a.archive, **more).awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
