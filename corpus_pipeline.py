"""The corpus pipeline: quality, near duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the docs of the next one. All but the last return the columns of documents. Each runs over everything that the one before it kept.
"""

from __future__ import annotations

import uuid

from glyphloom.llm import jaccard, mixing, packing, quality, secrets
from glyphloom.llm.common import shared_folder, table


def good_quality(spark, docs, sf_dir):
    """Drops documents that the classifier, learned from labels outside of the held-out third, rejects."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark, docs, sf_dir):
    """Keeps the smallest doc_id of each group of documents linked by five-word shingles at a Jaccard similarity of 0.8 or more."""
    return jaccard.one_of_each(docs, n=5, num=80, den=100)


def without_secrets(spark, docs, sf_dir):
    """Replaces credentials by a mark; all documents stay."""
    return secrets.redact(docs, secrets.fit(docs))


def mixed(spark, docs, sf_dir):
    """Emits each document as often as the mixture takes it."""
    return mixing.mix(docs)


def packed(spark, docs, sf_dir):
    """Cuts the token stream into sequences: a row for each piece."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the automata; tests/llm/test_pipeline.py holds all stages against plain Python.
ORACLE_SQL = None


def _delete(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def run(spark, sf_dir):
    """All stages over documents. What stands between them is written below the shared folder of spark.checkpoint.dir; a table is deleted when the next one is written, so only the last one stays, from which the result is read."""
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{base}/{i}")
            docs = spark.read.parquet(f"{base}/{i}")
            if i:
                _delete(spark, f"{base}/{i - 1}")
    return docs
