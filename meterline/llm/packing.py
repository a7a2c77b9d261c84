"""Best-fit packing of tokenized documents into sequences of a fixed length.

A text becomes the ids of a public tokenizer and a closing id; only what is longer than a sequence is cut. The
exact lengths of all pieces form a histogram of at most ``CAPACITY`` classes, the only thing that the driver sees. Over
it the configuration linear program (patterns of classes that fit a sequence, every piece covered, as few
patterns as possible) is solved by multiplicative weights: a knapsack by dynamic programming prices the
best pattern for the current weights, the pattern is used, and the weights of what it covers fall. Counts are rounded
down and the rest goes, longest first, to where it leaves least room. Pieces then take places of their class by rank,
in parallel, and the offsets follow from the few pieces of each sequence.

Null and empty texts are documents of one piece, the closing id alone. Texts longer than a sequence are cut. Repeated rows
are packed one by one; pieces of equal length go by their ids' checksum, then by doc_id and piece. An empty table has no
pieces. Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import by_size, give_back, ranked, remembered, small_batches, sorted_slices, together
from meterline.session import cut

VOCABULARY = "word_bpe_49k.json"
CAPACITY, CLOSING = 4096, 1
#: Steps of the multiplicative weights, and the share of the scarcest class that a step uses.
STEPS, STEP = 400, 0.3
#: Classes that are priced one by one at most, and the groups that more of them are priced in.
EXACT_CLASSES, GROUPS = 48, 1024
#: A piece's first weight is this power of its length: a little more for long ones, so that short ones are left for the rounding.
SLOPE = 1.05
#: Words whose ids a worker remembers, bytes of texts that it cuts into words at a time, words that the tokenizer is handed at once.
REMEMBERED, TOGETHER, AT_ONCE = 250_000, 2_000_000, 20_000

_TOKENIZERS: dict[str, object] = {}


#: Signs that end a word of letters and are then a part of their own; an apostrophe may begin a contraction.
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _lowered(text: bytes) -> bytes:
    """ASCII letters in lower case, as the tokenizer makes them, where no combining mark or special token may differ."""
    return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()


def _letters(stem: bytes) -> bytes:
    """A word of letters beyond ASCII as the tokenizer's rules leave it; empty if it is none."""
    word = stem.decode()
    low = word.lower()
    # a capital sigma is the one letter whose lower case depends on its place
    good = low.isalpha() and word.isalpha() and "Σ" not in word and unicodedata.is_normalized("NFC", word)
    return low.encode() if good else b""


class WordIds:
    """Ids of words, remembered as Arrow arrays: an object for each word would take many times their size.

    Blanks are never part of a token of this vocabulary. When there are too many words, those that the last texts had are kept.
    """

    def __init__(self, vocabulary: str) -> None:
        self.vocabulary = vocabulary
        self.words = pa.array([""], pa.string())
        self.ids = pa.array([[]], pa.list_(pa.uint32()))
        self.signs: dict[bytes, bytes] = {b"": b""}

    def tokenizer(self):
        if self.vocabulary not in _TOKENIZERS:
            import os

            import public_tokenizers
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

            path = self.vocabulary if os.sep in self.vocabulary else public_tokenizers.path(self.vocabulary)
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            made = Tokenizer.from_file(path)
            last = np.zeros(made.get_vocab_size(), bool)
            for token, number in made.get_vocab().items():
                last[number] = token.endswith("</w>")
            # for words of lower-case letters, which the rules of the vocabulary leave as they are
            plain = Tokenizer(made.model)  # the same tables
            plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
            _TOKENIZERS[self.vocabulary] = made, plain, last
        made, self.plain, self.last = _TOKENIZERS[self.vocabulary]
        return made

    def encoded(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts: each distinct word is looked up once, and its ids are put at all its places by Arrow.

        Words are what the six ASCII blanks leave; the empty ones at the ends of a text have no ids.
        """
        cut_up = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        table = cut_up.flatten().dictionary_encode()
        known = self.places(table.dictionary)
        places = known[table.indices.to_numpy()]
        size = pc.list_value_length(self.ids).to_numpy()
        data = self.ids.take(pa.array(places)).flatten().to_numpy().tobytes()
        upto = np.concatenate([[0], np.cumsum(size[places], dtype=np.int64)])
        ends = (upto[cut_up.offsets.to_numpy()] * 4).tolist()
        if len(self.words) > REMEMBERED:
            kept = pa.array(np.unique(known))
            self.words, self.ids = self.words.take(kept), self.ids.take(kept)
        return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words are among those remembered; new ones are learned."""
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(found))
        place = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).copy()
        if len(new):
            place[place < 0] = len(self.words) + np.arange(len(new))
            ids = self.learned(new)
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, _lists(ids)])
        return place

    def known(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of those words that are remembered."""
        places = pc.index_in(pa.array(words, pa.binary()).cast(pa.string()), value_set=self.words)
        there = np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False))
        lists = self.ids.take(places.drop_null())
        data = lists.flatten().to_numpy().tobytes()
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64) * 4]).tolist()
        return {words[i]: data[a:b] for i, a, b in zip(there.tolist(), at[:-1], at[1:], strict=True)}

    def learned(self, new: pa.Array) -> list[bytes]:
        words = [word for part in range(0, len(new), AT_ONCE) for word in new[part : part + AT_ONCE].cast(pa.binary()).to_pylist()]
        if len(self.signs) > REMEMBERED:
            self.signs = {b"": b""}
        stems = [word.rstrip(_SIGNS) for word in words]  # no byte of a longer character is among the signs
        plain = [stem.lower() if stem.isalpha() else _letters(stem) for stem in stems]
        every = list({x for x in plain if x})
        letters = self.known(every)
        self._learn_letters([x for x in every if x not in letters], letters)
        signs, out, other = self.signs, [b""] * len(words), []
        for i, (word, stem, x) in enumerate(zip(words, stems, plain, strict=True)):
            if not x:
                other.append(i)
            elif len(stem) == len(word):
                out[i] = letters[x]
            else:
                end = word[len(stem) :]
                if end not in signs:
                    signs[end] = self._ids([end])[0]
                out[i] = letters[x] + signs[end]
        for at in range(0, len(other), AT_ONCE):
            some = other[at : at + AT_ONCE]
            for i, ids in zip(some, self._ids([words[i] for i in some]), strict=True):
                out[i] = ids
        return out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer().encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn_letters(self, new: list[bytes], letters: dict[bytes, bytes]) -> None:
        """One call for many of them: every word of letters ends with a token that ends a word."""
        self.tokenizer()
        for start in range(0, len(new), AT_ONCE):
            some = new[start : start + AT_ONCE]
            ids = np.array(self.plain.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) != len(some):
                letters.update(zip(some, self._ids(some), strict=True))
                continue
            data, at = ids.tobytes(), 0
            for word, to in zip(some, ends.tolist(), strict=True):
                letters[word] = data[at:to]
                at = to


def _lists(ids: list[bytes]) -> pa.Array:
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(ids), "<u4")))


def word_ids(vocabulary: str) -> WordIds:
    return remembered(f"ids {vocabulary}", lambda: WordIds(vocabulary))


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if wanted) of all documents."""
    small_batches(docs.sparkSession)
    closing = np.array([CLOSING], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        known = word_ids(vocabulary)
        for held in together(batches, TOGETHER):
            rows = [text for batch in held for text in batch.column(1).to_pylist()]
            texts = [ids for part in by_size(rows, TOGETHER) for ids in known.encoded([_lowered(t) for t in part])]
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, ids_of in enumerate(texts):
                data = ids_of + closing
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [pa.concat_arrays([batch.column(0) for batch in held]).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)] + [pa.array(ids, pa.list_(pa.int32()))] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    extra = ", ids array<int>" * with_ids
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint{extra}")


@dataclass(frozen=True)
class Plan:
    """Runs of places: pieces of class ``kind`` with ranks from ``first`` on go ``per`` to a sequence, from ``base`` on."""

    kind: np.ndarray
    first: np.ndarray
    per: np.ndarray
    base: np.ndarray
    sequences: int


def best_choices(weight: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For every room the class that the heaviest filling takes first, -1 for none; without limits on numbers of pieces."""
    units = len(weight)
    open_ = np.flatnonzero(left > 0)
    size, value = open_ + 1, weight[open_].astype(np.float32)
    dense = 4 * len(open_) > units  # then all sizes are gone through in place, without a gather
    every = np.full(units, -np.inf, np.float32)
    turned = np.zeros(units + 1, np.float32)  # ``most`` from the end
    every[open_] = value
    most = np.zeros(units + 1, np.float32)
    choice = np.full(units + 1, -1)
    fitting = np.searchsorted(size, np.arange(units + 1), side="right")
    for room in range(1, units + 1):
        n = fitting[room]
        if n == 0:
            continue
        total = turned[units - room + 1 :] + every[:room] if dense else most[room - size[:n]] + value[:n]
        k = int(total.argmax())
        if total[k] > most[room - 1]:
            most[room], choice[room] = total[k], fitting[k + 1] - 1 if dense else k
        else:
            most[room] = most[room - 1]
        turned[units - room] = most[room]
    return np.where(choice < 0, -1, open_[choice]) if len(open_) else choice


def filled(choice: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Counts per class of the filling by ``choice``; what is not there is replaced by the largest pieces that fit."""
    units, open_ = len(left), np.flatnonzero(left > 0)
    counts = np.zeros(units, np.int64)
    room, spare = units, 0
    while room > 0:
        c = choice[room]
        if c < 0:
            room -= 1
            spare += 1
            continue
        if counts[c] < left[c]:
            counts[c] += 1
        else:
            spare += c + 1
        room -= c + 1
    for c in open_[::-1]:
        if spare <= c:
            continue
        more = min(int(left[c] - counts[c]), spare // int(c + 1))
        counts[c] += more
        spare -= more * int(c + 1)
    return counts


def best_pattern(weight: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Counts per class (class c takes c + 1 units) of the pattern of most weight that the pieces left allow."""
    return filled(best_choices(weight, left), left)


def program(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, rounded down, for a histogram over classes (class c takes c + 1 units).

    The configuration linear program by multiplicative weights: the pattern of most weight is used for a share of what
    its scarcest class still needs, and the weights of what it covers fall. What it leaves uncovered is left to the rounding.
    """
    units = len(demand)
    base = ((np.arange(units) + 1.0) / units) ** SLOPE
    covered, weight = np.zeros(units), np.ones(units)
    found: dict[bytes, list] = {}
    goal = demand.astype(float)
    for _ in range(STEPS):
        rest = np.maximum(np.ceil(goal - covered - 1e-9), 0).astype(np.int64)
        if not rest.any():
            break
        pattern = best_pattern(base * weight, rest)
        used = np.flatnonzero(pattern)
        amount = STEP * ((goal - covered)[used] / pattern[used]).min()
        if amount < 1:
            amount = min(1.0, ((goal - covered)[used] / pattern[used]).min())
        covered[used] += amount * pattern[used]
        weight[used] *= np.exp(-0.1 * amount * pattern[used] / goal[used])
        entry = found.setdefault(pattern.tobytes(), [pattern, 0.0])
        entry[1] += amount
    return [(pattern, int(amount + 1e-9)) for pattern, amount in found.values() if amount + 1e-9 >= 1]


class _Seats:
    """Runs of places as they are given out, and the room that is left in the sequences, as runs of equal room."""

    def __init__(self, demand: np.ndarray) -> None:
        self.left, self.taken = demand.astype(np.int64).tolist(), [0] * len(demand)
        self.rows: list[tuple[int, int, int, int]] = []
        self.rooms: dict[int, list[tuple[int, int]]] = {}  # room: runs (first sequence, how many)
        self.open = 0  # a bit for every room that there is
        self.sequences = 0

    def give(self, kind: int, per: int, base: int, times: int) -> None:
        """``per`` pieces of a class to each of ``times`` sequences from ``base`` on."""
        self.rows.append((kind, self.taken[kind], per, base))
        self.taken[kind] += per * times
        self.left[kind] -= per * times

    def room(self, room: int, base: int, times: int) -> None:
        if room > 0 and times > 0:
            self.rooms.setdefault(room, []).append((base, times))
            self.open |= 1 << room

    def best_fit(self) -> None:
        """All pieces that are left, the longest first, each to the sequence that it leaves least room in.

        Equal pieces go to a sequence until it has no room for one more, so runs of equal room are served at once.
        """
        for kind in range(len(self.left) - 1, -1, -1):
            size = kind + 1
            while self.left[kind]:
                fitting = self.open >> size
                if not fitting:
                    times = -(-self.left[kind] // (len(self.left) // size))
                    self.room(len(self.left), self.sequences, times)
                    self.sequences += times
                    continue
                room = size + (fitting & -fitting).bit_length() - 1
                base, times = self.rooms[room].pop()
                if not self.rooms[room]:
                    self.open &= ~(1 << room)
                per = room // size
                whole = min(times, self.left[kind] // per)
                if whole:
                    self.give(kind, per, base, whole)
                    self.room(room - per * size, base, whole)
                    base, times = base + whole, times - whole
                last = self.left[kind]
                if times and last:  # fewer than fill one more sequence
                    self.give(kind, last, base, 1)
                    self.room(room - last * size, base, 1)
                    base, times = base + 1, times - 1
                self.room(room, base, times)

    def seat(self, patterns: list[tuple[np.ndarray, int]], unit: int) -> None:
        """Sequences by patterns of groups of ``unit`` classes; a group gives its longest pieces first."""
        at = [min(len(self.left), (g + 1) * unit) - 1 for g in range(-(-len(self.left) // unit))]
        for pattern, times in patterns:
            base, cuts = self.sequences, {self.sequences: 0, self.sequences + times: 0}
            used: list[tuple[int, int, int]] = []  # from, to, size
            for g in np.flatnonzero(pattern):
                for _ in range(pattern[g]):
                    first = base
                    while first < base + times:
                        while not self.left[at[g]]:
                            at[g] -= 1
                        kind = at[g]
                        n = min(self.left[kind], base + times - first)
                        self.give(kind, 1, first, n)
                        used.append((first, first + n, kind + 1))
                        first += n
                        cuts[first] = 0
            edges = sorted(cuts)
            full = np.zeros(len(edges), np.int64)
            for a, b, size in used:
                full[np.searchsorted(edges, a)] += size
                full[np.searchsorted(edges, b)] -= size
            for a, b, load in zip(edges[:-1], edges[1:], np.cumsum(full)[:-1].tolist(), strict=True):
                self.room(len(self.left) - load, a, b - a)
            self.sequences += times

    def plan(self) -> Plan:
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 4)
        return Plan(*rows.T.copy(), self.sequences)


def plan(demand: np.ndarray) -> Plan:
    """Places for a histogram of pieces per class: the program's patterns, and the rest by best fit into what room they leave.

    Many classes are priced in groups, by the longest of a group; the rounding goes by exact lengths again. Where plain best fit of all
    pieces needs no more sequences, that is taken: a program of few steps can be worse on a long tail of classes.
    """
    units = len(demand)
    unit = 1 if np.count_nonzero(demand) <= EXACT_CLASSES else max(1, units // GROUPS)
    grouped = np.add.reduceat(demand.astype(np.int64), np.arange(0, units, unit))
    both = []
    for patterns in (program(grouped), []):
        seats = _Seats(demand)
        seats.seat(patterns, unit)
        seats.best_fit()
        both.append(seats)
    return min(both, key=lambda seats: seats.sequences).plan()


def solve(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """The sequences of a plan as patterns (pieces per class) and how often each is there."""
    p = plan(demand)
    inside = np.zeros((p.sequences, len(demand)), np.int64)
    end = np.where(np.append(p.kind[1:], -1) == p.kind, np.append(p.first[1:], 0), demand[p.kind])
    for kind, first, per, base, to in zip(p.kind, p.first, p.per, p.base, end, strict=True):
        inside[base : base + (to - first) // per, kind] += per
    patterns, times = np.unique(inside, axis=0, return_counts=True)
    return list(zip(patterns, times.tolist(), strict=True))


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (as from ``pieces``) with sequence_id and offset."""
    kind = F.col("length").cast("long") - 1
    order = ["__kind", "length", "ids_crc32", "__id", "piece"]
    rows = parts.withColumns({"__kind": kind, "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long"))})
    held = sorted_slices(rows, order, "pieces")
    demand = np.zeros(capacity, np.int64)
    for c, n in held.groupBy("__kind").count().collect():  # at most capacity rows
        demand[c] = n
    steps = plan(demand)
    shared = parts.sparkSession.sparkContext.broadcast(steps)

    def run(batches):
        p = shared.value
        key = p.kind * (1 << 44) + p.first
        for batch in batches:
            c, rank = (batch.column(i).to_numpy() for i in (0, 1))
            at = np.searchsorted(key, c * (1 << 44) + rank, side="right") - 1
            sequence = p.base[at] + (rank - p.first[at]) // p.per[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(sequence)], [*names, "sequence_id"])

    names = parts.columns
    schema = ", ".join(f"`{n}` {k}" for n, k in parts.dtypes)
    seated = ranked(held, ["__kind"]).select("__kind", "__rank", *names).mapInArrow(run, f"{schema}, sequence_id bigint")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return seated.withColumn("offset", F.coalesce(before, F.lit(0)))


def pack(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    # written first: the range shuffle looks at its rows twice; a piece is a few numbers, so tasks share files
    return place(cut(pieces(docs, vocabulary).hint("rebalance"), "pieces"))
