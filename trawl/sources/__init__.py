"""Readers for seeds, lookup files, vectors, graphs, sitemaps, archives and index tables."""

from trawl.sources.readers import (  # noqa: F401
    prefix_paths, read_corpus, read_denylist, read_graph, read_index, read_keys, read_labels, read_seeds,
    read_sitemaps, read_targets, read_vector_text, read_vocab, read_warc,
)
