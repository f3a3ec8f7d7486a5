"""Operator 10, token counts of whole texts, huge ones by overlap resynchronisation.

Method. A text of more than `chunk` characters is encoded in overlapping chunks with offsets. Two neighbours are spliced at a place in their
overlap that is proven stable: white space at which the layout always ends a pre-token (see encoding), and after which both encodings have
the same ids at the same offsets up to another such place. If no such place is found, the overlap is widened, in the end to the whole text.
Shorter texts are encoded at once, from remembered pieces cut at the same kind of place.

Scale. One pass without shuffle; memory is one batch of texts and the bounded piece memory, however long a text is.

Defined cases. Null text: empty, no tokens. Null ids, repeated rows and an empty table pass through as they are.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.encoding import Encoder, encoder, tokenizer_path

CHUNK = 1 << 16
OVERLAP = 512
LIMIT = 2048


def stable(e: Encoder, text: str, at: int) -> bool:
    """Whether every encoding of a text around this place starts a new pre-token here, whatever else it holds."""
    if e.kind == "spaceless":
        return text[at] in " \n"
    return e.kind == "spaced" and text[at] == " " and 0 < at < len(text) - 1 and not text[at - 1].isspace() and not text[at + 1].isspace()


def _encode(e: Encoder, text: str, start: int, end: int) -> list[tuple[int, int]]:
    """(start offset, id) of each token of the slice."""
    got = e.tokenizer.encode(text[start:end], add_special_tokens=False)
    return [(start + s, i) for (s, _), i in zip(got.offsets, got.ids, strict=True)]


def splice(e: Encoder, text: str, left: list, right: list, low: int, high: int) -> int | None:
    """A stable place in [low, high) after which both encodings agree up to a later stable place, if there is one."""
    last = next((p for p in range(high - 1, low, -1) if stable(e, text, p)), None)
    first = next((p for p in range(low + 1, high) if stable(e, text, p)), None)
    if first is None or last is None or first >= last:
        return None
    a, b = ([t for t in side if first <= t[0] < last] for side in (left, right))
    return first if a and a == b else None


def ids_of(e: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Ids of a text, from overlapping chunks if it is longer than one."""
    done: list[tuple[int, int]] = []
    start, held = 0, _encode(e, text, 0, min(chunk, len(text)))
    end = min(chunk, len(text))
    while end < len(text):
        wide = overlap
        while True:
            low = max(start, end - wide)
            if low <= start:  # no place in the whole chunk: encode it again together with the next
                end = min(len(text), max(end, start + chunk) + (end - start))
                held = _encode(e, text, start, end)
                break
            to = min(len(text), low + max(chunk, 2 * wide))
            right = _encode(e, text, low, to)
            at = splice(e, text, held, right, low, end)
            if at is not None:
                done += [t for t in held if t[0] < at]
                held, start, end = [t for t in right if t[0] >= at], at, to
                break
            wide *= 2
    return [i for _, i in done + held]


def counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        e = encoder(path)
        for batch in batches:
            out = []
            for doc_id, n_bytes, text in zip(*common.columns(batch, "doc_id", "n_bytes", "text"), strict=True):
                n = e.count(text) if len(text) <= chunk else len(ids_of(e, text, chunk, overlap))
                out.append((doc_id, n_bytes, n, n > limit))
            yield common.record_batch(schema, out)

    return common.id_text(docs).withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(common.table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
