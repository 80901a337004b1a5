"""glyphloom: Spark-native preparation of text corpora into labelled line-recognition data."""
