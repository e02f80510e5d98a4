"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

A task gathers texts until `batch_bytes` are reached and encodes what is new in them in one call, so a call's memory is
bounded whatever the number and length of its texts; the encodings are dropped at once, only their lengths are kept. A text
longer than that is cut at safe boundaries, and the counts of its pieces are added. For the byte-level vocabulary a place is
safe before white space that follows anything but white space, between an ASCII letter and a digit, and between a letter
and a sign like a full stop: there its pattern always begins a new unit, whatever stands before or after, and no special string has such a place inside. So its texts
fall into words with the white space before them: every distinct word of a batch that the task has not met is encoded
once (at most `KNOWN` lengths are remembered, then they are met anew), and a text's count is the sum over its words. A
stretch without any safe place stays in one piece; other kinds of vocabularies encode whole texts. Special strings inside
texts are one token each, as the library has it; nothing is added, cut or padded.

The vocabulary file is read by the driver and broadcast; its size is fixed by the file, not by the data.

Defined cases: a null or empty text has 0 bytes and 0 tokens; very long texts are counted whole; repeated rows and null
ids are rows of their own; an empty table gives no rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# UTF-8 bytes (about) that one call encodes.
BATCH_BYTES = 1 << 20
LIMIT = 512
# Lengths of words that a task remembers, and the longest word among them.
KNOWN, KNOWN_LENGTH = 500_000, 100
# White space as the byte-level pattern has it: fixed value of the Unicode property.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Where that pattern always begins a new unit, and the stretches between such places at the ends of words.
SAFE = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])|(?<=[A-Za-z])(?=[0-9.,;:!?()\"])|(?<=[0-9])(?=[A-Za-z])")
WORD = re.compile(rf"[{SPACE}]*[A-Za-z]+(?=[.,;:!?()\"])|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def counter(name: str, content: bytes):
    """A function from a list of texts to their numbers of tokens, and whether the safe places hold for it."""
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], False
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    model = tokenizers.Tokenizer.from_str(content.decode("utf-8"))
    model.no_truncation()
    model.no_padding()
    split = model.pre_tokenizer
    safe = (
        isinstance(split, tokenizers.pre_tokenizers.ByteLevel)
        and split.use_regex
        and not split.add_prefix_space
        and model.normalizer is None
        and not any(
            SAFE.search(t.content) or t.lstrip or t.rstrip or t.single_word for t in model.get_added_tokens_decoder().values()
        )
    )
    return lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)], safe


def pieces(text: str, size: int) -> Iterator[str]:
    """The text, cut at the first safe place after each `size` characters."""
    at = 0
    while len(text) - at > size:
        m = SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


class Lengths:
    """Numbers of tokens of batches of texts."""

    def __init__(self, count, safe: bool):
        self.count, self.safe, self.known = count, safe, {}

    def __call__(self, texts: list[str]) -> list[int]:
        if not self.safe:
            return self.count(texts)
        words = [WORD.findall(t) for t in texts]
        if len(self.known) > KNOWN:
            self.known.clear()
        new = list(set().union(*words).difference(self.known))
        here = dict(zip(new, self.count(new)))
        self.known.update((w, n) for w, n in here.items() if len(w) <= KNOWN_LENGTH)
        known = self.known
        return [sum([known[w] if w in known else here[w] for w in own]) for own in words]


def counted(texts, lengths: Lengths, batch_bytes: int) -> list[int]:
    """Tokens per text; calls are cut by bytes, so a long text may be spread over several."""
    totals = [0] * len(texts)
    held, owners, size = [], [], 0

    def flush():
        nonlocal held, owners, size
        for owner, n in zip(owners, lengths(held)):
            totals[owner] += n
        held, owners, size = [], [], 0

    # at most 4 bytes a character: a piece of a quarter of the batch in characters never exceeds it
    most = max(1, batch_bytes // 4)
    for owner, text in enumerate(texts):
        if not text:
            continue
        for piece in pieces(text, most) if lengths.safe and len(text) > most else (text,):
            n = len(piece) if piece.isascii() else len(piece.encode("utf-8", "surrogatepass"))
            if held and size + n > batch_bytes:
                flush()
            held.append(piece)
            owners.append(owner)
            size += n
    if held:
        flush()
    return totals


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per document. One pass, no shuffle.

    tokenizer: path of a .json or .model file on the driver.
    """
    name = Path(tokenizer).name
    content = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())

    def rows(batches):
        lengths = Lengths(*counter(name, content.value))
        for batch in batches:
            ids, texts, n_bytes = batch.columns
            tokens = counted(texts.to_pylist(), lengths, batch_bytes)
            over = [n > limit for n in tokens]
            yield pa.RecordBatch.from_arrays(
                [ids, n_bytes, pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return read.mapInArrow(rows, SCHEMA)
