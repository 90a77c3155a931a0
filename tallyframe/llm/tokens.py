"""Token counts of whole texts, as a tokenizer file of the ``tokenizers`` library gives them.

Texts of at most ``CHUNK`` characters are encoded whole: words between ASCII white space, at which neither
normalisation, pre-tokens nor special strings reach across, each distinct word of a batch once.

Huge texts are encoded in overlapping chunks with offsets, so that memory follows the chunk. Two neighbours are spliced
at a token that both have, with the same id at the same place, in their overlap. One such token is proof: merges
in rank order, leftmost first, treat a run of whole tokens alike whatever stands around it, so what precedes it
in the first chunk and what follows it in the second are the tokens of the joined text. What must hold for that:

* a chunk starts and ends where a character begins that composes with nothing before it, outside special strings and
  not within three characters after an apostrophe; its first pre-token is then the rest of a true one;
* the common token ends ``EDGE`` characters before the first chunk does, beyond any special string or contraction
  that the end may have cut, and its neighbours' offsets do not overlap its own (several tokens of one character).

Where an overlap holds no such token it is doubled, up to half a chunk; where that fails too, the text is encoded
anew in chunks four times as long, at last in one.

This holds for BPE files whose pre-tokens do not look back over white space; ``check_tokenizer`` refuses others.
Defined results: a null text counts as empty, 0 tokens. Special strings inside texts count as the library's default
has them. Rows are counted one by one, repeated ones too; other columns stay.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.staging import columns_of, fresh

CHUNK = 1 << 14
OVERLAP = 256
#: At least the longest special string, and the longest contraction.
EDGE = 32
#: Distinct words remembered by a Python worker, and the longest of them.
MEMORY, MEMORY_WORD = 1 << 18, 48


def check_tokenizer(data: bytes) -> None:
    """Raise ValueError unless words between white space are encoded independently of each other."""
    told = json.loads(data)
    model = told["model"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("fuse_unk"):
        raise ValueError("only plain BPE tokenizers are supported")
    if told.get("post_processor") is not None:
        raise ValueError("a post-processor may change tokens across chunks")
    for added in told["added_tokens"]:
        text = added["content"]
        if added["lstrip"] or added["rstrip"] or added["normalized"] or any(c.isspace() for c in text) or len(text) >= EDGE:
            raise ValueError(f"the added token {text!r} may reach across white space")
    steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = [s for s in steps if s["type"] == "Split"]
    if len(split) != 1 or split[0]["behavior"] != "Removed" or not split[0]["invert"]:
        raise ValueError("only pre-tokens that leave white space out are supported")


class Encoder:
    """A tokenizer and how it is applied to short and to huge texts."""

    def __init__(self, data: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode("utf-8"))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t["content"] for t in json.loads(data)["added_tokens"]]
        self.chunk, self.overlap = chunk, overlap
        self.counts: dict[bytes, int] = {}

    def count_all(self, texts: list[str | None]) -> list[int]:
        """The number of tokens of every text."""
        out, short = [0] * len(texts), []
        for k, text in enumerate(texts):
            if text and len(text) > self.chunk:
                out[k] = self.count_huge(text)
            elif text:
                short.append((k, text.encode("utf-8").split()))
        with self._remembered({w for _, words in short for w in words}) as counts:
            for k, words in short:
                out[k] = sum(map(counts.__getitem__, words))
        return out

    @contextmanager
    def _remembered(self, words: set[bytes]) -> Iterator[dict[bytes, int]]:
        """The counts of the words; beyond MEMORY of them, and for long ones, only for as long as they are used."""
        if len(self.counts) > MEMORY:
            self.counts = {}
        new = [w for w in words if w not in self.counts]
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False)
        self.counts.update(zip(new, map(len, encoded)))
        yield self.counts
        for w in new:
            if len(w) > MEMORY_WORD:
                del self.counts[w]

    def count_huge(self, text: str) -> int:
        chunk = self.chunk
        while chunk < len(text):
            n = self._spliced(text, chunk)
            if n is not None:
                return n
            chunk *= 4
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def _spliced(self, text: str, chunk: int) -> int | None:
        """The count in chunks of this length, or None where two chunks have no common token."""
        end = self._cut(text, chunk, 0)
        if end is None:
            return None
        ids, spans = self._encoded(text, 0, end)
        total, first = 0, 0  # tokens before `first` are counted
        while end < len(text):
            overlap = self.overlap
            following = self._cut(text, min(len(text), end + chunk // 2), end)
            if following is None:
                return None
            while True:
                if overlap > chunk // 2:
                    return None
                start = self._cut(text, end - overlap, end - chunk // 2 - EDGE)
                if start is not None:
                    next_ids, next_spans = self._encoded(text, start, following)
                    met = self._common(ids, spans, first, next_ids, next_spans, end - EDGE)
                    if met is not None:
                        break
                overlap *= 2
            total += met[0] + 1 - first
            ids, spans, first, end = next_ids, next_spans, met[1] + 1, following
        return total + len(ids) - first

    def _encoded(self, text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int]]]:
        found = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        return found.ids, [(a + start, b + start) for a, b in found.offsets]

    def _cut(self, text: str, at: int, least: int) -> int | None:
        """The last place from ``at`` down, above ``least``, where a chunk may start or end."""
        if at >= len(text):
            return len(text)
        while at > max(least, 0):
            if _begins(text[at]) and "'" not in text[max(0, at - 3) : at + 1] and not self._in_special(text, at):
                return at
            at -= 1
        return None

    def _in_special(self, text: str, at: int) -> bool:
        return any(0 <= text[max(0, at - len(s) + 1) : at + len(s) - 1].find(s) for s in self.specials)

    @staticmethod
    def _common(ids, spans, first, next_ids, next_spans, limit) -> tuple[int, int] | None:
        """Indexes of the last token that both have before ``limit``, both counted from the start of their lists."""
        places = {}
        for k, span in enumerate(next_spans):
            if span[0] >= limit:
                break
            if _apart(next_spans, k):
                places[span] = k
        for k in range(len(ids) - 1, first - 1, -1):
            if not next_spans or spans[k][0] < next_spans[0][0]:
                return None
            met = places.get(spans[k])
            if spans[k][1] <= limit and met is not None and ids[k] == next_ids[met] and _apart(spans, k):
                return k, met
        return None


def _begins(char: str) -> bool:
    """Whether normalisation joins the character to nothing before it: neither a mark nor a Jamo vowel or tail."""
    code = ord(char)
    return code < 0x300 or not (
        unicodedata.category(char)[0] in "MC" or 0x1100 <= code <= 0x11FF or 0xD7B0 <= code <= 0xD7FF
    )


def _apart(spans: list[tuple[int, int]], k: int) -> bool:
    a, b = spans[k]
    return a < b and (k == 0 or spans[k - 1][1] <= a) and (k + 1 == len(spans) or b <= spans[k + 1][0])


@lru_cache(maxsize=2)
def _encoder(data: bytes, chunk: int, overlap: int) -> Encoder:
    return Encoder(data, chunk, overlap)


def token_count(spark: SparkSession, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """A function from a text column to its number of tokens; ``tokenizer`` is the path of a file on the driver.

    The file, of fixed size, is sent to the executors, which need no copy.
    """
    with open(tokenizer, "rb") as f:
        data = f.read()
    check_tokenizer(data)
    sent = spark.sparkContext.broadcast(data)

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        encoder = _encoder(sent.value, chunk, overlap)
        out: list[int] = []
        for part in _parts(texts):
            out += encoder.count_all(part.to_pylist())
        return pa.array(out, pa.int64())

    return lambda text: count(text)


def _parts(texts: pa.Array, rows: int = 256):
    for start in range(0, len(texts), rows):
        yield texts.slice(start, rows)


def with_token_counts(docs: DataFrame, tokenizer: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` and n_bytes, n_tokens and over_limit, renamed where the documents have such columns."""
    n_bytes, n_tokens, over_limit = fresh(docs, "n_bytes", "n_tokens", "over_limit")
    column: Column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counted = docs.select(
        *columns_of(docs),
        F.octet_length(column).cast("bigint").alias(n_bytes),
        token_count(docs.sparkSession, tokenizer)(column).alias(n_tokens),
    )
    return counted.withColumn(over_limit, F.col(n_tokens) > limit)
