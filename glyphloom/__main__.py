"""Command line: python -m glyphloom --help. Exit codes: 0, 1 for bad options or inputs, 130 when interrupted."""

from __future__ import annotations

import sys

from . import config


def main(argv: list[str] | None = None) -> int:
    for stream in (sys.stdout, sys.stderr):  # labels and titles are in any script, consoles need not be
        if hasattr(stream, "reconfigure"):
            stream.reconfigure(encoding="utf-8", errors="replace")
    o = config.parser().parse_args(argv)
    try:
        config.check(o)
        if o.download_wiki_dump:
            from .sources.discover import download

            for name in o.download_wiki_dump:
                print(download(name, o.download_dir, o.wiki_dump_url))
            if not o.source and not o.use_default_sources and not o.label_source_manifest:
                return 0
        from pyspark.sql import SparkSession

        from .plans import dataset

        spark = SparkSession.builder.appName("glyphloom").getOrCreate()
        print(f"done: {dataset.run(spark, o)} lines")
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    except KeyboardInterrupt:
        print("stopped", file=sys.stderr)
        return 130
    return 0


if __name__ == "__main__":
    sys.exit(main())
