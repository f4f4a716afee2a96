"""Sequence packing as a cutting-stock problem solved by column generation.

A document is tokenised where it lies and cut into full sequences and one remainder. Only the
histogram of remainder lengths, at most ``length / grain`` classes, reaches the driver: there a
linear program over patterns (how many remainders of each class fill one sequence) is solved by
the revised simplex method, an unbounded-knapsack dynamic program prices new patterns, and the
rounded patterns become a table of slots. Remainders are ranked within their class and meet the
slot of their rank in a join. Nothing that grows with the documents leaves the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.common import running_sums, small_batches, text_bytes
from kerbside.session import store

if TYPE_CHECKING:
    import numpy as np
    import pyarrow as pa

LENGTH = 2048
GRAIN = 8          # width of a length class in tokens
END = 1            # id that ends every document
KNOWN_WORDS = 300_000
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe, which may belong to the letters behind it
PORTION = 8_000_000   # bytes of text in whose words' numbers are held at a time
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁ]+$"   # of words that are cut from the marks around them together; others one by one
SENT = 4_096          # pieces sent on at a time


def tokenised(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_column: str = "doc_id",
              text_column: str = "text") -> DataFrame:
    """Pieces of at most ``length`` ids: (id, start, length, ids, doc_tokens).

    ``ids`` are little-endian unsigned 32-bit integers. The ids of a text are those of its
    words, as the tokenizer drops white space; a Python worker keeps the words it has met.
    """
    def pieces(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words = _words(tokenizer)
        for batch in batches:
            keys, texts = batch.columns
            portion = np.cumsum(pc.binary_length(texts).to_numpy()) // PORTION
            cuts = [0, *(np.flatnonzero(np.diff(portion)) + 1).tolist(), len(texts)]
            for first, end in zip(cuts, cuts[1:]):
                raw, totals = words.numbered(texts.slice(first, end - first))
                n = -(-totals // length)
                row = np.repeat(np.arange(end - first), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * length
                size = np.minimum(totals[row] - start, length)
                place = np.append(0, np.cumsum(size)) * 4
                for at in range(0, len(row), SENT):
                    own, to = slice(at, at + SENT), min(at + SENT, len(row))
                    offsets = (place[at:to + 1] - place[at]).astype(np.int32)
                    held = pa.Array.from_buffers(pa.binary(), to - at, [
                        None, pa.py_buffer(offsets), raw.slice(int(place[at]), int(place[to] - place[at]))])
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(row[own] + first)), pa.array(start[own]), pa.array(size[own]), held,
                         pa.array(totals[row[own]])], ["key", "start", "length", "ids", "doc_tokens"])
                held = raw = None
        # a worker that waits for its next task keeps the words it knows, and no buffers of this one
        batch = keys = texts = None
        pa.default_memory_pool().release_unused()

    kind = docs.schema[id_column].dataType.simpleString()
    given = small_batches(docs).select(F.col(id_column).alias("key"), text_bytes(text_column).alias("text"))
    cut = given.mapInArrow(pieces, f"key {kind}, start long, length long, ids binary, doc_tokens long")
    return cut.withColumnRenamed("key", id_column)


@lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    """One for the tasks that a Python worker runs one after another."""
    return _Words(path)


class _Words:
    """Ids of words by the tokenizer at ``path``, as bytes, remembered up to a fixed number."""

    def __init__(self, path: str) -> None:
        import os
        import re

        import numpy as np
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        # the units a word falls into; fixed by the tokenizer
        self.units = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        # words of these lower-case letters are a unit each; written in the model's own letters, which
        # stand for bytes, they only need to be merged
        self.merging = Tokenizer.from_file(path)
        self.merging.normalizer, self.merging.pre_tokenizer = None, pre_tokenizers.CharDelimiterSplit(" ")
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        lower = [c for c in map(chr, range(0x482)) if re.match(LETTERS, c) and c == c.lower()]
        self.written = {ord(c): level.pre_tokenize_str(c)[0][0] for c in lower if not c.isascii()}
        some = f"[{''.join(lower)}]+"
        self.plain, self.all_plain = re.compile(some).fullmatch, re.compile(f"{some}(?: {some})*").fullmatch
        self.known: dict[bytes, bytes] = {}

    def numbered(self, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
        """The ids of binary texts one after another, each text's end id behind it, and their numbers by text."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = texts.view(pa.string())   # need not be UTF-8: only ASCII is looked at
        # the tokenizer lowers letters; only its special strings are told apart by case
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
        coded = split.flatten().dictionary_encode()
        own = pa.concat_arrays([self._of(coded.dictionary), pa.array([END.to_bytes(4, "little")], pa.large_binary())])
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        held = own.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(own) - 1)))
        after = np.cumsum(pc.binary_length(held).to_numpy()) // 4
        return held.buffers()[2], np.diff(after[ends + np.arange(len(ends))], prepend=0)

    def _of(self, words: pa.Array) -> pa.Array:
        """Ids of words. Letters and the marks around them are units of their own, which many words share."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        marks = MARKS.decode()
        behind = pc.ascii_ltrim(words, marks)
        core = pc.ascii_rtrim(behind, marks)
        whole, left, size = (pc.binary_length(x).to_numpy() for x in (words, behind, core))
        cut = (size < whole) & pc.match_substring_regex(core, LETTERS).to_numpy(zero_copy_only=False)
        cut &= ~pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
        # a word's three parts lie next to each other in the bytes of all words
        begin = np.append(0, np.cumsum(whole))
        places = np.empty(3 * len(words) + 1, np.int32)
        places[::3], places[1::3] = begin, begin[:-1] + np.where(cut, whole - left, 0)
        places[2::3] = places[1::3] + np.where(cut, size, whole)
        held = pa.py_buffer(b"".join(words.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()))
        parts = pa.Array.from_buffers(pa.binary(), 3 * len(words), [None, pa.py_buffer(places), held]).dictionary_encode()
        used = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn([used])
        ids = pa.array(map(self.known.__getitem__, used), pa.large_binary(), size=len(used))
        codes = parts.indices.to_numpy()
        return pc.binary_join_element_wise(*[ids.take(pa.array(codes[k::3])) for k in range(3)], pa.scalar(b"", pa.large_binary()))

    def learn(self, texts: list[list[bytes]]) -> None:
        """Make all words of these texts known; many are encoded in one call, as a call costs most.

        Letters and the marks around them are units of their own, so that such a word is put together
        from the ids of its parts. Where too many words are known, those of these texts stay.
        """
        used = set().union(*texts)
        new = [word for word in used if word not in self.known]
        if len(new) + len(self.known) > KNOWN_WORDS:
            self.known = {word: self.known[word] for word in used.difference(new)}
        letters, whole, marked = [], set(), []
        for word, text in zip(new, _decoded(new)):
            if self.plain(text):
                letters.append(word)
                continue
            core = word.strip(MARKS)
            if core and len(core) < len(word) and b"<|" not in word and core.decode("utf-8", "replace").isalpha():
                marked.append((word, [part for part in word.partition(core) if part]))
                whole.update(part for part in marked[-1][1] if part not in used and part not in self.known)
            else:
                whole.add(word)
        for some in (letters, list(whole)):
            for begin in range(0, len(some), 500):
                self._encode(some[begin:begin + 500])
        for word, parts in marked:
            self.known[word] = b"".join(map(self.known.__getitem__, parts))

    def _encode(self, words: list[bytes]) -> None:
        import unicodedata

        import numpy as np

        texts = plain = _decoded(words)
        tokenizer, joined = self.merging, " ".join(texts)
        if self.all_plain(joined):
            joined, counts = joined.translate(self.written), [1] * len(texts)
        else:
            tokenizer, plain = self.tokenizer, [w for w in texts if "<|" not in w]
            joined = " ".join(plain)
            units, normal = self.units.findall, unicodedata.normalize
            counts = [1 if w.isalpha() else len(units(normal("NFC", w).lower())) for w in plain]
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        last = np.flatnonzero(self.ends[ids])
        if len(plain) < len(texts) or len(last) != sum(counts):   # rare: special or uncommon characters
            for word, text in zip(words, texts):
                encoded = self.tokenizer.encode(text, add_special_tokens=False).ids
                self.known[word] = np.array(encoded, "<u4").tobytes()
            return
        # a word without a unit ends where the one before it does
        ends = (4 * np.append(0, last + 1)[np.cumsum(counts)]).tolist()
        raw = ids.tobytes()
        self.known.update((word, raw[begin:end]) for word, begin, end in zip(words, [0, *ends], ends))


def _decoded(words: list[bytes]) -> list[str]:
    """Words, which hold no space, as text."""
    return b" ".join(words).decode("utf-8", "replace").split(" ") if words else []


def patterns(demand: dict[int, int], capacity: int, rounds: int = 1500,
             gap: float = 5e-4) -> list[tuple[int, dict[int, int]]]:
    """(times, {size: copies}) that together hold exactly the demanded number of each size.

    The linear program is solved until no pattern prices above one, or until Farley's bound is
    within ``gap``. Its solution is rounded down; what remains is filled best-first.
    """
    import numpy as np

    sizes = np.array(sorted(size for size, n in demand.items() if n), int)
    if not len(sizes):
        return []
    wanted = np.array([demand[s] for s in sizes], float)
    m = len(sizes)
    columns, used, inverse = _greedy(sizes, wanted, capacity)
    bound = 0.0
    for _ in range(rounds):
        value, pattern = _knapsack(sizes, inverse.sum(0), capacity)
        bound = max(bound, used.sum() / value)   # Farley's lower bound
        if value <= 1 + 1e-9 or used.sum() - bound <= max(gap * bound, 0.5):
            break
        step = _times(inverse, pattern)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, used / step, np.inf)
        leaving = int(ratio.argmin())
        if not np.isfinite(ratio[leaving]):
            break
        theta = ratio[leaving]
        used = np.maximum(used - theta * step, 0)
        used[leaving] = theta
        _exchange(inverse, step, leaving)
        columns[:, leaving] = pattern
    left, plan = wanted.astype(int), []
    for j in np.argsort(-used, kind="stable"):
        pattern = columns[:, j].astype(int)
        held = pattern > 0
        times = min(int(used[j] + 1e-6), int((left[held] // pattern[held]).min()))
        if times > 0:
            plan.append((times, {int(sizes[i]): int(pattern[i]) for i in np.flatnonzero(held)}))
            left -= times * pattern
    while left.any():   # at most about one sequence for each pattern of the basis
        room, pattern = capacity, np.zeros(m, int)
        for i in range(m - 1, -1, -1):
            pattern[i] = min(left[i], room // sizes[i])
            room -= pattern[i] * sizes[i]
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        plan.append((times, {int(sizes[i]): int(pattern[i]) for i in np.flatnonzero(held)}))
        left -= times * pattern
    return plan


def _greedy(sizes, wanted, capacity: int):
    """A basis to start from: largest sizes first, each pattern used until a size is exhausted."""
    import numpy as np

    m, left = len(sizes), wanted.copy()
    columns, used = np.diag((capacity // sizes).astype(float)), np.zeros(m)
    inverse = np.diag(1.0 / np.diag(columns))
    while (left > 1e-9).any():
        room, pattern = capacity, np.zeros(m)
        for i in np.flatnonzero(left > 1e-9)[::-1]:
            pattern[i] = min(room // sizes[i], max(1, int(left[i])))
            room -= int(pattern[i]) * sizes[i]
        held = np.flatnonzero(pattern)
        first = held[(left[held] / pattern[held]).argmin()]
        _exchange(inverse, _times(inverse, pattern), first)
        columns[:, first], used[first] = pattern, left[first] / pattern[first]
        left = left - used[first] * pattern
        left[first] = 0
    return columns, used, inverse


def _times(inverse, pattern):
    """The matrix times a vector of few entries."""
    held = pattern.nonzero()[0]
    return (inverse[:, held] * pattern[held]).sum(1)


def _exchange(inverse, step, leaving: int) -> None:
    """Bring a column into the basis in place of column ``leaving``."""
    row = inverse[leaving] / step[leaving]
    inverse -= step[:, None] * row
    inverse[leaving] = row


def _knapsack(sizes, prices, capacity: int):
    """The pattern of most value, sizes used any number of times."""
    import numpy as np

    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        n = np.searchsorted(sizes, room, "right")
        best[room] = best[room - 1]
        if n:
            value = best[room - sizes[:n]] + prices[:n]
            i = int(value.argmax())
            if value[i] > best[room] + 1e-12:
                best[room], choice[room] = value[i], i
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        i = choice[room]
        if i < 0:
            room -= 1
            continue
        pattern[i] += 1
        room -= sizes[i]
    return best[capacity], pattern


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, grain: int = GRAIN,
         carry: dict[str, Column] | None = None, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """Pack tokenised documents into sequences of at most ``length`` ids.

    Returns a row per piece: id, start, length, doc_tokens, sequence_id, offset and the columns
    of ``carry``, expressions over a piece's ``ids`` (default: the ids themselves).

    Null and empty texts hold the end id alone. Texts of any length are cut into full sequences
    and a remainder. Repeated ids and rows are packed as separate documents; null ids are kept.
    An empty table gives an empty one. Other columns are not read.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    cut = tokenised(docs, tokenizer, length, id_column, text_column)
    cut = cut.select(F.col(id_column).alias("__id"), "start", "length", "doc_tokens",
                     *[c.alias(name) for name, c in carry.items()])
    pieces = store(cut)
    rest = pieces.where(F.col("length") < length).withColumn("__size", F.ceil(F.col("length") / grain))
    # at most length / grain rows
    demand = {r["__size"]: r["n"] for r in rest.groupBy("__size").agg(F.count("*").alias("n")).collect()}
    slots, base, seen = [], 0, dict.fromkeys(demand, 0)
    for times, pattern in patterns(demand, length // grain):
        for size, copies in pattern.items():
            slots.append((size, seen[size], seen[size] + times * copies, copies, base))
            seen[size] += times * copies
        base += times
    plan = docs.sparkSession.createDataFrame(
        slots, "`__size` long, `__from` long, `__to` long, `__copies` long, `__base` long")
    ranked = running_sums(rest.withColumn("__one", F.lit(1)), "__size", "__one",
                     ["__id", "length", *[c for c in carry if c != "ids"]], "__rank")
    # the plan has a few rows for each class: bounded by the number of classes
    placed = ranked.alias("r").join(F.broadcast(plan).alias("p"), (F.col("r.__size") == F.col("p.__size")) & (
        F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    placed = placed.withColumn("sequence_id", F.expr("__base + (__rank - __from) div __copies"))
    names = ["__id", "start", "length", "doc_tokens", *carry]
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "__rank", "r.__size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = placed.select(*names, "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    whole = pieces.where(F.col("length") == length).withColumn("__one", F.lit(1)).withColumn("__all", F.lit(0))
    whole = running_sums(whole, "__all", "__one", ["__id", "start"], "__rank").select(
        *names, (F.col("__rank") + base).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(whole).withColumnRenamed("__id", id_column)
