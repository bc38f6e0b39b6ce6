"""Packing by power-of-two decomposition of documents.

A document of ``n`` tokens (its ids and the end id) is cut into as many pieces of
``MAX_TOKENS`` as fit and, for the rest, one piece per binary digit of its length, longest
first. Each piece is a sequence of its own whose length is a power of two: no sequence
crosses documents and none is padded. Sequences of equal length form a bucket, from which
batches of one shape can be drawn.

A null text counts as empty; an empty text gives the end id alone. Repeated rows and ids are
packed like any other; a null id stays null. An empty table gives no pieces. Other columns
take no part. A very long text is tokenised in parts between spaces, which the vocabulary
never joins; memory is the text and its ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.llm.common import map_batches, texts_of

MAX_TOKENS = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

#: Words whose ids one worker remembers before it starts afresh, about 200 bytes each, and the
#: characters and bytes of ids that they and theirs may have in all.
REMEMBERED_WORDS = 600_000
REMEMBERED_BYTES = 64 * 1024 * 1024
_TOKEN_BYTES = 4

#: Punctuation that may end a word of letters without changing how the letters are cut.
_ENDINGS = ".,;:!?#$%&*|\"()-"


def _shown_bytes() -> list[str]:
    """The character that byte-level vocabularies show each byte as.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(byte) if byte in plain else chr(next(others)) for byte in range(256)]


_SHOWN_BYTES = _shown_bytes()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of texts from a word-level BPE file: it drops white space, so no id spans a space.

    Texts are therefore cut at spaces and each word is encoded once and remembered. A word of
    letters with punctuation behind it is two words to the vocabulary, so it is put together
    from them, and letters go to the model directly, in the form the file prepares them in.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._known: dict[str, bytes] = {"": b""}
        self._held = 0

    def _letters(self, word: str) -> bytes | None:
        """Ids of a word of letters only, or nothing where its prepared form is less certain."""
        lowered = word.lower()
        if not (word.isascii() or ("\u03a3" not in word and is_normalized("NFC", word) and lowered.isalpha())):
            return None
        shown = "".join([_SHOWN_BYTES[byte] for byte in lowered.encode()])
        return np.array([token.id for token in self._model.tokenize(shown)], "<u4").tobytes()

    def _encode(self, word: str) -> bytes:
        known, found = self._known, None
        letters = word.rstrip(_ENDINGS)
        if letters.isalpha():
            found = known.get(letters)
            if found is None:
                found = self._letters(letters)
            if found is not None and len(letters) < len(word):
                known[letters] = found
                self._held += len(letters) + len(found)
                ending = word[len(letters) :]
                if ending not in known:
                    known[ending] = self._whole(ending)
                found += known[ending]
        if found is None:
            found = self._whole(word)
        known[word] = found
        self._held += len(word) + len(found)
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        words = text.split(" ")
        if len(self._known) > REMEMBERED_WORDS or self._held > REMEMBERED_BYTES:
            self._known, self._held = {"": b""}, 0
        found = list(map(self._known.get, words))
        if None in found:
            known, encode = self._known, self._encode
            found = [known.get(w) or encode(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
        return b"".join(found)


@cache
def tokenizer_of(path: str) -> WordTokenizer:
    """One tokenizer per worker process, so that what it remembers outlasts a task."""
    return WordTokenizer(path)


def piece_lengths(tokens: int, longest: int = MAX_TOKENS) -> list[int]:
    """Lengths of a document's pieces; ``longest`` is a power of two."""
    rest = tokens % longest
    digits = [1 << bit for bit in range(longest.bit_length() - 2, -1, -1) if rest >> bit & 1]
    return [longest] * (tokens // longest) + digits


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    longest: int = MAX_TOKENS,
    end_id: int = END_ID,
    path: str | None = None,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``doc_tokens``, ``ids``, ``sequence_id``, ``offset``, ``bucket``.

    ``start`` counts the tokens of the document before the piece. ``ids`` are its token ids
    as little-endian unsigned 32-bit numbers. ``bucket`` is the binary logarithm of the
    length. ``sequence_id`` is unique within the result, ``offset`` is 0. ``path`` is a
    tokenizer file that every executor has; by default the installed vocabulary's.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"The longest sequence must be a power of two, not {longest}.")
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(path or vocabulary_path())
        owner, starts, lengths, totals, pieces = [], [], [], [], []
        for row, text in enumerate(texts_of(batch.column(1))):
            data, at = tokenizer.ids(text) + end, 0
            total = len(data) // _TOKEN_BYTES
            for length in piece_lengths(total, longest):
                owner.append(row)
                starts.append(at)
                lengths.append(length)
                totals.append(total)
                pieces.append(data[_TOKEN_BYTES * at : _TOKEN_BYTES * (at + length)])
                at += length
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(owner, pa.int32())),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(pieces, pa.binary()),
            ],
            names=["id", "start", "length", "doc_tokens", "ids"],
        )

    kind = docs.schema[id_column].dataType.simpleString()
    pairs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {kind}, start long, length long, doc_tokens long, ids binary"
    return map_batches(pairs, run, schema).select(
        F.col("id").alias(id_column),
        "start",
        "length",
        "doc_tokens",
        "ids",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        (F.length(F.bin("length")) - 1).alias("bucket"),
    )
