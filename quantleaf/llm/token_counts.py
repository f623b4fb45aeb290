"""Token counts of a SentencePiece BPE model, without materialising the ids of documents.

Pieces are counted once per distinct pre-token of the corpus; the counts are joined to each document's
pre-token frequencies and summed. A pre-token is a run of spaces with the letters up to the next
space or line feed, letters after a line feed, or one line feed: the model has no piece with a space
behind other letters and none with a line feed, so no merge crosses these limits.

Defined results: a null or empty text has 0 bytes and 0 tokens. Repeated rows, equal and null ids give one row
each. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import encode_once, make_blocks, resolve

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"                    # the model's sign for a space
_PRETOKEN = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def split(text: str) -> list[str]:
    """Pre-tokens of a text; the model puts a space before it."""
    return _PRETOKEN.findall(SPACE + text.replace(" ", SPACE)) if text else []


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_pieces(tokens: list[str], path: str) -> list[list[int]]:
    """Number of pieces of each pre-token, taken after a line feed, which keeps the model's own space out of it."""
    return [[len(ids) - 2] for ids in _processor(path).encode(["\n" + t for t in tokens], num_threads=1)]


def check_model(path: str) -> None:
    """The limits of pre-tokens hold for this model."""
    p = _processor(path)
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        if "\n" in piece or SPACE in piece.lstrip(SPACE):
            raise ValueError(f"pieces of this model cross the limits of pre-tokens: {piece!r}")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens of each document. ``path``: a model file that all executors can read."""
    path = path or model_path()
    check_model(path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = make_blocks(rows, split, bags=True)

    def finish(block: dict, starts: np.ndarray, values: np.ndarray) -> dict:
        weighted = np.concatenate([[0], np.cumsum(values[block["numbers"]].astype(np.int64) * block["times"])])
        return {"doc_id": block["ids"], "n_bytes": pa.array(block["n_bytes"]),
                "n_tokens": pa.array(weighted[block["ends"][1:]] - weighted[block["ends"][:-1]])}

    return resolve(blocks, encode_once(blocks, lambda: lambda tokens: count_pieces(tokens, path)), finish,
                   f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, n_tokens long")


def op2_query(docs: DataFrame) -> DataFrame:
    return count_tokens(docs).withColumn("over_limit", F.col("n_tokens") > LIMIT)
