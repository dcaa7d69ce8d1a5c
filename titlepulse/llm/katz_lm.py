"""A Katz backoff language model, counted over the training documents, and the scores of all documents.

Tokens are lower-cased words and one end.  ``score`` is over every word and n-gram; ``katz_whole`` says how.

Null and empty texts are scored as one end.  Repeated rows, with equal ids or texts, count and are scored as often as
they come.  Without training documents all counts are 0, and a token not seen has all the mass.  An empty table gives
an empty result.  A null id counts as the empty text for the choice of training documents.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import lower_words_of

ORDER = 3
DISCOUNTED = 5
HELD_OUT_OF, HELD_OUT = 7, 2
END = b""


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % HELD_OUT_OF == HELD_OUT


def bare(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def documents(batches):
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            yield doc_id, [*lower_words_of(text.as_py()), END]


def discounts(histogram: dict[int, int]) -> list[float]:
    """The factor for counts 0 to ``DISCOUNTED``, by Good and Turing with Katz's correction.

    Where the numbers of counts do not give a factor between 0 and 1, as in small corpora, (n - 1/2) / n is taken.
    """
    n = [0, *[histogram.get(r, 0) for r in range(1, DISCOUNTED + 2)]]
    spare = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    out = [1.0]
    for r in range(1, DISCOUNTED + 1):
        factor = ((r + 1) * n[r + 1] / (r * n[r]) - spare) / (1 - spare) if n[r] and spare < 1 else 0.0
        out.append(factor if 0 < factor < 1 else (r - 0.5) / r)
    return out


def score(docs: DataFrame, order: int = ORDER, **options) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``options`` are the sizes of blocks and buckets, and the one from which contexts are split; the scores are the same with any.
    """
    from titlepulse.llm import katz_whole

    return katz_whole.score(docs, order, **options)
