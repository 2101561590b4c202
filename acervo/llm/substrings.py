"""Substring dedup by seed and extend: documents meet on winnowed anchors, matches grow both ways to maximal repeats.

A seed that occurs again is grown to the left and right into a segment; segments alike throughout are matched at once,
those that differ alignment by alignment, so a match ends where the texts part; touching matches are joined to maximal spans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from acervo.llm.common import staged
from acervo.llm.repeats import aligned, anchored, assembled, candidates, contexts, cut, firsts, seeded, settled, with_texts

SEED_WORDS = 8


def deduplicated(docs: DataFrame, window: int = 20, seed: int = SEED_WORDS) -> DataFrame:
    """Words covered by a run of `window` words that also starts earlier are removed: doc_id, n_words, n_removed, n_spans,
    kept_sha256 (of the kept words joined by one blank).

    Words are parted by ASCII white space and compared as they are. Earlier means a smaller doc_id (null first), or the
    same document and a smaller place; runs are judged on the input. A null text has no words. Rows that share doc_id
    and text are one document, each row getting its result; of rows that share doc_id alone the smaller text hash comes
    first. A copy of a whole document of `window` words or more is removed whole. An empty table gives no row; other
    columns play no part.
    """
    found = anchored(docs, "word", seed, window)
    first = staged(firsts(found, window), "firsts")
    texts = contexts(candidates(docs, seeded(found, first)), "word", window, seed)
    copies, different = settled(texts)
    ranges = copies.union(aligned(with_texts(texts, different), "word", window))
    removed = cut(texts, ranges, "word", window)
    return assembled(found, first, removed, window).withColumnRenamed("n", "n_words").withColumnRenamed("sha", "kept_sha256")
