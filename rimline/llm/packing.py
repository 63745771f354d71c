"""Hierarchical packing: documents into context windows of several lengths.

A document's whole long windows are cut off first. What is left of it goes to the tier of the
smallest window that holds it. From the longest tier down, each piece opens a window, whose gap
is filled with the longest pieces of shorter tiers that fit; if none fits, the shortest longer
one is cut. So all windows are full, save the last of a task. Windows of a tier are
dealt to step groups of equally many tokens.

Every task packs the documents it reads, block by block: no shuffle, no state beyond a block.

Defined cases: a null or empty text is the end token alone; a null id stays null; rows with
equal ids are packed as documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rimline.llm.common import LONG_WORD, slices, table, utf8

#: Window lengths, longest first; all powers of two, so full ones need no padding.
TIERS = (4096, 2048, 1024, 512)
#: The rest of a task goes to windows of halved lengths down to this, then to one padded window.
LEAST_WINDOW = 64
END_ID = 2
TOKENS_PER_STEP = 1 << 18
#: Tokens that wait in a task before they are packed.
BLOCK_TOKENS = 1 << 22
ID_BYTES = 4
#: Text whose words are looked up together: of more text, fewer are distinct.
GROUP_BYTES = 1 << 23
#: Words, and parts of words, that a worker remembers at least.
REMEMBERED = 400_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Sequence ids are the task's number and a count within the task.
TASK_SHIFT = 40

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Recent(dict):
    """What was looked up lately: at most twice ``size`` entries, the older half dropped at a time."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size, {}

    def __missing__(self, key: bytes) -> bytes:
        value = self.older[key]
        self[key] = value
        return value

    def knows(self, key: bytes) -> bool:
        return key in self or key in self.older

    def turn(self) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()

    def forget(self) -> None:
        self.older = {}
        self.clear()


def core_and_tail(word: bytes) -> tuple[bytes, bytes]:
    """A word's letters in lower case and its last punctuation, where the tokenizer parts them; else the word itself.

    A folded special token would become ordinary text or the other way round; signs of other scripts may join with
    punctuation, so after other than ASCII and Latin letters the word stays whole.
    """
    core = word.rstrip(PUNCTUATION)
    tail = word[len(core) :]
    if b"<|" in word or not core:
        return word, b""
    if tail and not core[-1:].isalnum():
        last = core.decode()[-1]
        if not ("\u00c0" <= last <= "\u024f" and last.lower()[-1].isalpha()):
            return word, b""
    return core.lower(), tail


def byte_signs() -> dict[int, int]:
    """The sign that stands for each byte in byte-level vocabularies: printable Latin ones are themselves, the others follow from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(others)}


BYTE_SIGNS = byte_signs()


def is_plain(part: bytes) -> bool:
    """Whether folding changes nothing: Latin letters in lower case, composed."""
    text = part.decode()
    return text.isalpha() and max(text) <= "\u024f" and text == text.lower() and unicodedata.is_normalized("NFC", text)


class WordIds:
    """Token ids of words as little-endian bytes, remembered up to a bound.

    The tokenizer drops white space and never joins what it parts, so a text's ids are those of its words in
    turn. It also folds case and parts letters from punctuation, so a word is looked up as its
    core in lower case and the ASCII punctuation after that. What is not known is encoded in one call for many texts.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words, self.parts = Recent(remembered), Recent(remembered)

    def _encode(self, parts: list[bytes]) -> None:
        rest = []
        tokenize, ids = self.model.tokenize, self.parts
        for part in parts:
            if part.isalpha() or is_plain(part):
                # One run of lower-case letters, which the tokenizer passes to its model as it is, byte by byte.
                ids[part] = array("I", [token.id for token in tokenize(part.decode("latin-1").translate(BYTE_SIGNS))]).tobytes()
            else:
                rest.append(part)
        self._encode_others(rest)

    def _encode_others(self, parts: list[bytes]) -> None:
        for at in range(0, len(parts), 50_000):
            some = parts[at : at + 50_000]
            found = self.tokenizer.encode([p.decode() for p in some], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(some)), side="right")
            start = 0
            for part, end in zip(some, ends.tolist()):
                self.parts[part] = ids[start:end].tobytes()
                start = end

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Words are told apart by Arrow, so that each is looked up once for all texts; ids are then gathered."""
        words, parts = self.words, self.parts
        words.turn()
        parts.turn()
        # Spaces at the ends leave empty words, which have no ids. A view does not look at the bytes.
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        coded = split.values.dictionary_encode()
        distinct = coded.dictionary.view(pa.large_binary()).to_pylist()
        cores = {}
        known = words.older.get
        for word in distinct:
            if word not in words:
                value = known(word)
                if value is None:
                    cores[word] = (word.lower(), b"") if word.isalpha() else core_and_tail(word)
                else:
                    words[word] = value
        self._encode(sorted({p for pair in cores.values() for p in pair if p and not parts.knows(p)}))
        parts[b""] = b""
        for word, (core, tail) in cores.items():
            words[word] = parts[core] + parts[tail] if tail else parts[core]
        found = [words[word] for word in distinct]
        for word, (core, _) in cores.items():
            if len(word) > LONG_WORD:
                del words[word]
                parts.pop(core, None)
        return self._gathered(found, coded.indices.to_numpy(), split.offsets.to_numpy())

    def forget(self) -> None:
        """Gives the memory back that words and Arrow's unused buffers take; the tokenizer stays."""
        self.words.forget()
        self.parts.forget()
        pa.default_memory_pool().release_unused()

    @staticmethod
    def _gathered(found: list[bytes], places: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The ids of each text: those of its words, which are named by their places in ``found``."""
        counts = np.fromiter(map(len, found), np.int64, len(found)) // ID_BYTES
        starts = np.cumsum(counts) - counts
        held = counts[places]
        upto = np.concatenate(([0], np.cumsum(held)))
        at = np.repeat(starts[places] - upto[:-1], held)
        at += np.arange(len(at))
        ids = np.frombuffer(b"".join(found), "<u4")[at].tobytes()
        bounds = (upto[ends] * ID_BYTES).tolist()
        return [ids[start:end] for start, end in zip(bounds, bounds[1:])]


@cache
def word_ids(path: str, remembered: int) -> WordIds:
    """One for a worker process, whatever the number of its tasks."""
    return WordIds(path, remembered)


def grouped(slices: Iterable[dict[str, list]], size: int) -> Iterator[list[dict[str, list]]]:
    """Slices in turn, as many together as hold some ``size`` bytes of text."""
    group, held = [], 0
    for rows in slices:
        group.append(rows)
        held += sum(map(len, rows["text"]))
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


class Packer:
    """The windows of one task."""

    def __init__(self, tiers: tuple[int, ...], tokens_per_step: int, task: int):
        self.tiers, self.tokens_per_step, self.task = tiers, tokens_per_step, task
        self.by_length: dict[int, list[tuple]] = {}
        self.lengths = 0  # Bit n is set while a piece of n tokens waits.
        self.waiting = 0
        self.windows = 0
        self.tier_tokens = dict.fromkeys(tiers, 0)

    def add(self, doc: tuple, tokens: int) -> Iterator[tuple]:
        """doc: its id, ids and number of tokens."""
        longest = self.tiers[0]
        whole = tokens - tokens % longest
        for start in range(0, whole, longest):
            yield from self.window([(doc, start, longest)])
        if tokens > whole:
            self.put((doc, whole, tokens - whole))

    def put(self, piece: tuple) -> None:
        self.by_length.setdefault(piece[2], []).append(piece)
        self.lengths |= 1 << piece[2]
        self.waiting += piece[2]

    def take(self, length: int) -> tuple:
        waiting = self.by_length[length]
        piece = waiting.pop()
        if not waiting:
            self.lengths ^= 1 << length
        self.waiting -= length
        return piece

    def longest_within(self, most: int) -> int:
        return (self.lengths & ((2 << most) - 1)).bit_length() - 1

    def filled(self, size: int) -> list[tuple]:
        """A full window of ``size``; needs as many waiting tokens."""
        parts, gap = [], size
        while gap:
            fit = self.longest_within(gap)
            if fit > 0:
                parts.append(self.take(fit))
                gap -= fit
            else:
                above = self.lengths >> (gap + 1)
                doc, start, length = self.take(gap + 1 + (above & -above).bit_length() - 1)
                parts.append((doc, start, gap))
                self.put((doc, start + gap, length - gap))
                gap = 0
        return parts

    def drain(self) -> Iterator[tuple]:
        """Full windows, tier by tier, while there are pieces of the tier and tokens to fill it."""
        for size, shorter in zip(self.tiers, (*self.tiers[1:], 0)):
            while self.waiting >= size and self.longest_within(size) > shorter:
                yield from self.window(self.filled(size))

    def finish(self) -> Iterator[tuple]:
        yield from self.drain()
        size = self.tiers[0]
        while size >= LEAST_WINDOW:
            while self.waiting >= size:
                yield from self.window(self.filled(size))
            size //= 2
        if self.waiting:
            yield from self.window(self.filled(self.waiting))

    def window(self, parts: list[tuple]) -> Iterator[tuple]:
        held = sum(length for _, _, length in parts)
        tier = next((size for size in reversed(self.tiers) if size >= held), self.tiers[0])
        at = self.tiers.index(tier)
        group = (self.task << TASK_SHIFT) | (at << (TASK_SHIFT - 4)) | (self.tier_tokens[tier] // self.tokens_per_step)
        self.tier_tokens[tier] += held
        sequence = (self.task << TASK_SHIFT) | self.windows
        self.windows += 1
        offset = 0
        for (doc_id, ids, tokens), start, length in parts:
            yield doc_id, start, length, ids[start * ID_BYTES : (start + length) * ID_BYTES], tokens, sequence, offset, tier, group
            offset += length


def _packing(path: str, tiers: tuple[int, ...], tokens_per_step: int, schema: pa.Schema, remembered: int, group_bytes: int, forget: bool):
    end = array("I", [END_ID]).tobytes()

    def emit(pieces: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        rows = []
        for piece in pieces:
            rows.append(piece)
            if len(rows) == 2048:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        words = word_ids(path, remembered)
        packer = Packer(tiers, tokens_per_step, TaskContext.get().partitionId())
        try:
            for group in grouped(slices(batches), group_bytes):
                found = iter(words.of([text for rows in group for text in rows["text"]]))
                for rows in group:
                    for doc_id, ids in zip(rows["doc_id"], found):
                        ids += end
                        tokens = len(ids) // ID_BYTES
                        yield from packer.add((doc_id, ids, tokens), tokens)
                    if packer.waiting >= BLOCK_TOKENS:
                        yield from packer.drain()
            yield from packer.finish()
        finally:
            if forget:
                words.forget()

    return lambda batches: emit(pieces(batches))


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    tokens_per_step: int = TOKENS_PER_STEP,
    remembered: int = REMEMBERED,
    group_bytes: int = GROUP_BYTES,
    forget: bool = False,
) -> DataFrame:
    """One row per piece: its document and place there, ids (little-endian uint32), window and place there.

    With ``forget``, workers remember words for a task only: they outlive it, and other stages need the memory.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(StructType.fromDDL(PIECES))
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return texts.mapInArrow(_packing(path, tiers, tokens_per_step, schema, remembered, group_bytes, forget), PIECES)


def op9_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group"
    )
