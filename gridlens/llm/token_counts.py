"""Token counts with a whole-token shortcut.

Offline, every vocabulary string that ends a word is encoded alone: those that give one token
are proved to count as one. Texts are cut at ASCII blanks, which never stand inside a token of
this tokenizer; each distinct piece goes through the library's own normaliser and
pre-tokenizer once, proved pre-tokens count one, and only the rest is merged by the library.

Defined cases: null and empty texts have 0 bytes and 0 tokens; whole texts are counted;
strings of special tokens inside a text count as the library's default has them; long pieces
are not remembered and the memory of pieces is cleared when full, which changes no count;
repeated rows each get their result; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

#: Distinct pieces remembered in a worker, and the longest that is remembered.
MEMORY, LONGEST = 400_000, 64


def prove(tokenizer_json: str) -> frozenset[str]:
    """Pre-tokens (in the tokenizer's byte letters) that alone are one token, each shown by encoding it."""
    import json

    from tokenizers import Tokenizer

    t, spec = Tokenizer.from_str(tokenizer_json), json.loads(tokenizer_json)
    end = spec["model"].get("end_of_word_suffix") or ""
    whole = [v.removesuffix(end) if end else v for v in spec["model"]["vocab"] if v.endswith(end)]
    return frozenset(v for v in whole if v and len(t.model.tokenize(v)) == 1)


class Counter:
    """Counts tokens of texts; what it has learnt of pieces is kept from batch to batch."""

    def __init__(self, tokenizer_json: str, whole: frozenset[str]):
        from tokenizers import Tokenizer

        self.t, self.whole, self.known = Tokenizer.from_str(tokenizer_json), whole, {"": 0}
        self.special = [x.content for x in self.t.get_added_tokens_decoder().values()]

    def piece(self, text: str) -> int:
        if any(s in text for s in self.special):
            return len(self.t.encode(text, add_special_tokens=False).ids)
        norm = self.t.normalizer.normalize_str(text) if self.t.normalizer else text
        n = 0
        for pre, _ in self.t.pre_tokenizer.pre_tokenize_str(norm):
            n += 1 if pre in self.whole else len(self.t.model.tokenize(pre))
        return n

    def count(self, text: str | None) -> int:
        known, total = self.known, 0
        for p in (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
            n = known.get(p)
            if n is None:
                n = self.piece(p)
                if len(p) <= LONGEST:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[p] = n
            total += n
        return total


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs; ``tokenizer`` is the path of a .json file."""
    spec = Path(tokenizer).read_text()
    shared = docs.sparkSession.sparkContext.broadcast((spec, prove(spec)))  # bounded by the vocabulary

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(*shared.value)
        for batch in batches:
            n = [counter.count(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": n, "over_limit": [x > limit for x in n]})

    rows = docs.selectExpr("doc_id", "coalesce(text, '') text", "cast(coalesce(octet_length(text), 0) as long) n_bytes")
    return rows.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
