"""Token counts without encoding (operator 9).

Every text is cut at spaces as the piece model does (a space opens a piece, no
piece spans "letter, space"). A segment's count is its symbols less its merges,
found once per distinct segment and worker, and summed over the text.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.merging import merge
from basketlens.llm.pretokens import Memo, rows_of

SPACED = re.compile(" +[^ ]*")


class SegmentCounts:
    """Tokens of segments (leading spaces included, the first of them dropped). One
    per worker process: later tasks find its memo again."""

    made: dict = {}

    @classmethod
    def of(cls, model: bytes) -> SegmentCounts:
        if model not in cls.made:
            cls.made.clear()
            cls.made[model] = cls(model)
        return cls.made[model]

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        sp = self.model
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        order = {s: n for n, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        self.rank = {sp.id_to_piece(i): order[sp.get_score(i)] for i in plain}
        if any("▁" in p.lstrip("▁") for p in self.rank):
            raise ValueError("a piece of this model spans a space: texts can't be cut at spaces")
        self.memo = Memo(self.segment)

    def segment(self, segment: str) -> int:
        # the normalizer puts the leading space back
        parts = merge(list(self.model.normalize(segment)) if segment else ["▁"], self.rank)
        # a symbol that is no piece falls back to its bytes
        return sum(1 if p in self.rank else len(p.encode()) for p in parts)

    def count(self, text: str) -> int:
        if not text:
            return 0
        # the model writes spaces as this sign, so in a text it is one
        text = text.replace("▁", " ")
        segments = text.split(" ")
        if "" in segments:
            segments = [s[1:] for s in SPACED.findall(" " + text)]
        return sum(map(self.memo.__getitem__, segments))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row of ``docs`` (doc_id, text).

    Counts are those of the piece model at ``model_path`` (no begin or end
    tokens; special strings are ordinary text). Null and empty texts: 0. Rows
    are independent: repeated rows give repeated results, an empty table none;
    a text of any length is counted whole. The model (fixed size) is broadcast.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches):
        counts = SegmentCounts.of(model.value)
        for batch in batches:
            ids, sizes, n = [], [], []
            for doc_id, text, n_bytes in rows_of(batch):
                ids += doc_id
                sizes += n_bytes
                n += [counts.count(t) if t else 0 for t in text]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                                   pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return (docs.select(F.col("doc_id").cast("long"), "text",
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
