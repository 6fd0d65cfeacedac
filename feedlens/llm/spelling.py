"""Spelling variants: words one code point apart, found with a bit-sliced position index.

The index holds a bitset over a vocabulary for every (position, letter) that
occurs. A word is run through it letter by letter: one recurrence keeps the
vocabulary words that agree so far, three more those with one replaced, one missing
and one more letter, whose later letters are read at the same position, one
before and one after. A numpy operation moves a batch of words against 64
vocabulary words a machine word.

Two words one code point apart, the shorter of s code points, agree in their first or in
their last (s - 1) / 2 ones (rounded up). So words meet by those halves, and a half
that many words share is cut further in the same way; every pair meets
in exactly one block, and blocks are bounded by the alphabet at the last cut."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import materialize

#: Words are counted in pieces of so many bytes, and counts leave a task at so many distinct words.
PIECE, FLUSH = 1 << 20, 1 << 18
#: A block of more words is cut further.
BLOCK = 4096
#: Blocks searched together: so many words, and letters, at most (or one block).
TOGETHER, LETTERS = 2048, 1 << 16
NEVER = 1 << 30

#: Letters are A-Z, a-z and U+00C0 to U+00FF, one Latin-1 byte each; A-Z become a-z and all else separates.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _pieces(text: str) -> Iterator[list[bytes]]:
    """The runs of letters of a whole text, a bounded number at a time."""
    line, at = text.encode("latin-1", "replace").translate(_TABLE), 0
    while at < len(line):
        end = line.find(b" ", at + PIECE)
        end = len(line) if end < 0 else end
        yield line[at:end].split()
        at = end


def noisy(word: bytes, salt: int, every: int) -> bytes:
    """``word`` (Latin-1) less one letter if ``every`` divides the crc32 of its UTF-8 form continued from ``salt``."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), salt)
    if h % every:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _counts(batches: Iterator[pa.RecordBatch], least: int, every: int) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def out():
        words = [w.decode("latin-1") for w in total]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            salt = zlib.crc32(f"{'' if key is None else key}:".encode())
            for runs in _pieces(text.as_py() or ""):
                for word, n in Counter(runs).items():
                    if len(word) >= least:
                        word = noisy(word, salt, every) if every else word
                        if len(word) >= least:
                            total[word] += n
                if len(total) >= FLUSH:
                    yield out()
                    total.clear()
    yield out()


def word_counts(docs: DataFrame, least: int, every: int = 0) -> DataFrame:
    """(word, n) of all words with ``least`` letters at least in the whole texts of ``docs`` (doc_id, text).

    ``every``: a document's word whose crc32 of '<doc_id>:<word>' it divides
    loses a letter first (0: none does). Null texts hold no words; a null doc_id is empty."""
    found = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(
        lambda bs: _counts(bs, least, every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class PositionIndex:
    """Bitsets over a vocabulary: one per (position, letter), and one per length."""

    def __init__(self, words: list[str]):
        self.size, self.slots = len(words), -(-len(words) // 64)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        of = np.repeat(np.arange(self.size), self.lengths)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.keys, row = np.unique(place << 21 | letters, return_inverse=True)
        self.bits = np.zeros((len(self.keys) + 1, self.slots), np.uint64)  # the last row: no word
        np.bitwise_or.at(self.bits, (row, of >> 6), np.uint64(1) << (of & 63).astype(np.uint64))
        self.of_length = {}
        for size in np.unique(self.lengths).tolist():
            at = np.flatnonzero(self.lengths == size)
            own = np.zeros(self.slots, np.uint64)
            np.bitwise_or.at(own, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
            self.of_length[size] = own

    def _rows(self, letters: np.ndarray, shift: int) -> np.ndarray:
        """The bitset of each letter of equally long words, read ``shift`` positions further."""
        key = np.maximum(np.arange(letters.shape[1]) + shift, 0) << 21 | letters
        at = np.searchsorted(self.keys, key)
        found = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == key)
        return np.where(found, at, len(self.keys))

    def near(self, words: list[str], shorter: bool, same: bool, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word, vocabulary word) numbers exactly one code point apart; ``words`` are equally long.

        ``shorter``, ``same``, ``longer``: which vocabulary words are sought."""
        size, none = len(words[0]), np.zeros(self.slots, np.uint64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, size)
        here = self._rows(letters, 0)
        before = self._rows(letters, -1) if shorter else None
        after = self._rows(letters, 1) if longer else None
        right = np.full((len(words), self.slots), ~np.uint64(0))
        replaced, missing, more = (np.zeros_like(right) for _ in range(3))
        for i in range(size):
            now = self.bits[here[:, i]]
            if same:
                replaced = replaced & now | right & ~now
            if shorter:  # without letter i, or without an earlier one and this letter a position before
                missing = (missing & self.bits[before[:, i]] | right) if i else right
            if longer:  # an extra letter before letter i, or before an earlier one
                more = (more | right) & self.bits[after[:, i]]
            right = right & now
        near = replaced & self.of_length.get(size, none)
        near |= missing & self.of_length.get(size - 1, none)
        if longer:
            near |= (more | right) & self.of_length.get(size + 1, none)
        q, slot = np.nonzero(near)
        bit = np.unpackbits(near[q, slot].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, k = np.nonzero(bit)
        return q[hit], slot[hit] * 64 + k


def _agree(a: list[str], b: list[str], size: np.ndarray) -> np.ndarray:
    """Whether the first ``size`` code points are equal."""
    return np.fromiter((x[:n] == y[:n] for x, y, n in zip(a, b, size.tolist())), bool, len(a))


def _search(rows: list[tuple]) -> tuple[list, list, list, list]:
    """word, number of near words, the largest count among them and its word, for the rows (key, s, below, word, n) of whole blocks, block by block."""
    block = np.cumsum(np.fromiter((i > 0 and r[0] != rows[i - 1][0] for i, r in enumerate(rows)), np.int64, len(rows)))
    s, below = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    words, n = [r[3] for r in rows], np.array([r[4] for r in rows], np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    asks, finds = [], []
    cut = 0
    while cut < len(rows):  # the vocabulary in tiles of bounded letters
        end = max(cut + 1, int(np.searchsorted(np.cumsum(size[cut:]), LETTERS, side="right")) + cut)
        end = min(end, cut + TOGETHER)
        index, blocks = PositionIndex(words[cut:end]), np.unique(block[cut:end])
        here = np.isin(block, blocks)
        for long in (False, True):
            for m in np.unique(size[here & (size == s + long)]).tolist():
                of = np.flatnonzero(here & (size == m) & (size == s + long))
                for k in range(0, len(of), TOGETHER):
                    part = of[k:k + TOGETHER]
                    q, w = index.near([words[i] for i in part.tolist()], shorter=long, same=not long, longer=not long)
                    q, w = part[q], w + cut
                    own = block[q] == block[w]
                    asks.append(q[own])
                    finds.append(w[own])
        cut = end
    q, w = np.concatenate(asks), np.concatenate(finds)
    limited = np.flatnonzero(below[q] < NEVER)  # those that agree in so many first letters meet in another block
    again = _agree([words[i] for i in q[limited].tolist()], [words[i] for i in w[limited].tolist()], below[q[limited]])
    keep = np.ones(len(q), bool)
    keep[limited[again]] = False
    q, w = q[keep], w[keep]
    by_word = np.argsort(np.argsort(np.array(words, object), kind="stable"), kind="stable")  # code-point order
    order = np.lexsort((by_word[w], -n[w], q))
    q, w = q[order], w[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(q)))
    return [words[i] for i in q[first].tolist()], count.tolist(), n[w[first]].tolist(), [words[i] for i in w[first].tolist()]


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Searches the blocks of a partition sorted by block, several small ones at once."""
    def out(rows):
        word, count, most, form = _search(rows)
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(count, pa.int64()), pa.array(most, pa.int64()),
                                           pa.array(form, pa.string())], ["word", "n_near", "form_n", "form"])

    rows: list[tuple] = []
    letters, whole = 0, 0  # letters of the rows, and how many rows belong to finished blocks
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if rows and row[0] != rows[-1][0]:
                whole = len(rows)
            rows.append(row)
            letters += len(row[3])
            if whole and (len(rows) > TOGETHER or letters > LETTERS):
                yield out(rows[:whole])
                rows, whole = rows[whole:], 0
                letters = sum(len(r[3]) for r in rows)
    if rows:
        yield out(rows)


def _blocks(words: DataFrame) -> DataFrame:
    """Every word in its blocks: s, the code points agreed on at the start (a) and the end (b), below, path, word, n.

    A word of length l is in the blocks of s = l (as the shorter or one of two equally long) and s = l - 1 (as the longer)."""
    half = F.ceil((F.col("s") - 1) / 2).cast("int")
    each = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("s"))
    return each.select("word", "n", "s", half.alias("half")).select(
        "word", "n", "s", F.explode(F.array(
            F.struct(F.col("half").alias("a"), F.lit(0).alias("b"), F.lit(NEVER).alias("below"), F.lit("<").alias("path")),
            F.struct(F.lit(0).alias("a"), F.col("half").alias("b"), F.col("half").alias("below"), F.lit(">").alias("path")))).alias("k")
    ).select("word", "n", "s", "k.*")


def _key() -> Column:
    """A block's name: path, s, and the code points agreed on."""
    end = F.when(F.col("b") > 0, F.expr("right(word, b)")).otherwise("")
    return F.concat_ws("|", "path", F.col("s").cast("string"), F.expr("left(word, a)"), end)


def _cut(rows: DataFrame) -> DataFrame:
    """The rows in the two finer blocks of their block: half of what may still differ, at its start or its end."""
    more = F.ceil((F.col("s") - F.col("a") - F.col("b") - 1) / 2).cast("int")
    return rows.withColumn("m", more).select("word", "n", "s", F.explode(F.array(
        F.struct((F.col("a") + F.col("m")).alias("a"), F.col("b").alias("b"), F.col("below").alias("below"), F.concat("path", F.lit("<")).alias("path")),
        F.struct(F.col("a").alias("a"), (F.col("b") + F.col("m")).alias("b"), F.least("below", F.col("a") + F.col("m")).alias("below"),
                 F.concat("path", F.lit(">")).alias("path")))).alias("k")).select("word", "n", "s", "k.*")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form_n, form) of every word of ``words`` (word, n; distinct words) with a word exactly one code point apart:
    their number, the largest n among them, and the word that has it (the smallest in code-point order)."""
    least = words.agg(F.min(F.length("word"))).first()[0] or 0
    done, todo = None, _blocks(words).where(F.col("s") >= least)  # no shorter word is there to be found
    while True:
        todo = materialize(todo.withColumn("key", _key()), "spelling-blocks")
        large = materialize(todo.groupBy("key").agg(F.count("*").alias("rows"), F.max(F.col("s") - F.col("a") - F.col("b")).alias("free"))
                            .where((F.col("rows") > block) & (F.col("free") > 1)).select("key"), "spelling-large")
        more = bool(large.head(1))
        fine = todo.join(large, "key", "left_anti") if more else todo
        done = fine if done is None else done.unionByName(fine)
        if not more:
            break
        todo = _cut(todo.join(large, "key", "left_semi").drop("key"))
    dealt = done.select("key", "s", "below", "word", "n").repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(_near_words, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))  # the largest count, then the smallest word
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best")["less"]).alias("form_n"), F.col("best")["form"].alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form; no cycles): the last word reached by following forms.

    Each round doubles the steps taken, so their number is the logarithm of the longest chain."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        got = materialize(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                F.col("further").isNotNull().alias("moved")), "spelling-roots")
        now = got.select("word", "root")
        if not got.where("moved").head(1):
            return now


def variants(docs: DataFrame, least: int = 6, times: int = 5, ratio: int = 5, every: int = 0, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word with ``least`` letters and ``times`` occurrences at least in ``docs``.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF of the whole
    texts, A-Z lower-cased (``every``: see ``word_counts``). A word's form is the near word (one code point inserted, deleted or replaced) of
    largest n, ties to the smaller in code-point order, if that n is ``ratio`` times the word's at
    least; root follows forms to the last. Null and empty texts hold no words, repeated rows
    count again, other columns are ignored, an empty table gives no rows.
    ``ratio`` is 2 at least, so chains of forms end."""
    if ratio < 2:
        raise ValueError("a form occurs at least twice as often as its variant")
    words = materialize(word_counts(docs, least, every).where(F.col("n") >= times), "spelling-words")
    near = words.join(near_words(words, block), "word", "left")
    named = F.col("form_n") >= F.lit(ratio) * F.col("n")
    formed = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(named, F.col("form")).alias("form"),
                                     F.when(named, F.col("form_n")).alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form is not null"))
    return (formed.join(ends, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
