"""SentencePiece encoding with seeded merge-dropout, and decoding."""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.llm.common import given_back
from framelark.llm.decontaminate import mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED, DROPOUT = 7, 0.1
#: Characters of the texts that are encoded together, occurrences that are cut at once, and words whose merges run in step.
TOGETHER, AT_ONCE, IN_STEP = 400_000, 50_000, 8_000
#: Longer words run by themselves, with a heap.
LONG = 100
#: Words whose cuts a Python worker remembers, about; beyond, it forgets those it has seen fewer than OFTEN times.
REMEMBERED, OFTEN = 200_000, 3
#: Cuts that it remembers, about; of words up to so many symbols, and after so many skipped candidates. What isn't remembered is worked out.
CUTS, SHORT, DEEPEST = 600_000, 24, 5
SPACE = "▁"
_WORDS = re.compile(r" *[^ ]+| +")
_NONE = np.iinfo(np.int64).max


def _key(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


_PLACE_BITS = 20


def _place(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _PLACE_BITS)).astype(np.int64)


class Pieces:
    """The model's pieces as arrays. Symbols are piece ids; characters without a piece are symbols from `outside` on.

    Spaces stand for themselves, so the model's space mark in a text has no piece and goes by its bytes; every text can be
    read back. No piece has a space after another character (checked), so words with their leading spaces never merge."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        self.outside = n
        self.byte = np.zeros(256, np.int32)
        self.bytes: list[bytes] = [b""] * n
        ids: dict[str, int] = {}
        for i, name in enumerate(names):
            if sp.is_byte(i):
                self.byte[int(name[3:5], 16)] = i
                self.bytes[i] = bytes([int(name[3:5], 16)])
            elif plain[i]:
                ids[name] = i
                self.bytes[i] = name.replace(SPACE, " ").encode()
        if any(SPACE in name.lstrip(SPACE) for name in ids):
            raise ValueError("a piece has a space after another character")
        self.first = np.arange(0x110000, dtype=np.int64) + self.outside
        for name, i in ids.items():
            if len(name) == 1:
                self.first[ord(name)] = i
        self.first[ord(" ")], self.first[ord(SPACE)] = self.first[ord(SPACE)], ord(SPACE) + self.outside

        def symbol(part: str) -> int | None:
            return ids.get(part, int(self.first[ord(part)]) if len(part) == 1 else None)

        pairs = []
        for name, i in ids.items():
            for cut in range(1, len(name)):
                a, b = symbol(name[:cut]), symbol(name[cut:])
                if a is not None and b is not None:
                    pairs.append((a << 32 | b, i))
        pairs.sort()
        self.pairs, self.merged = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
        # places by hash; pairs that find their place taken are left to a search
        self.place = np.zeros(1 << _PLACE_BITS, np.int32)
        at = _place(self.pairs)
        self.place[at[::-1]] = np.arange(len(pairs), dtype=np.int32)[::-1]
        crowded = self.place[at] != np.arange(len(pairs))
        self.rest, self.rest_merged = self.pairs[crowded], self.merged[crowded]
        self.crowded = np.zeros(1 << _PLACE_BITS, bool)
        self.crowded[at[crowded]] = True
        order = np.argsort([-sp.get_score(i) for i in range(n)], kind="stable")
        self.rank, self.by_rank = np.empty(n, np.int64), order
        self.rank[order] = np.arange(n)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols merge into, or -1."""
        key = left << 32 | right
        where = _place(key)
        at = self.place[where]
        out = np.where(self.pairs[at] == key, self.merged[at], -1)
        if len(self.rest) and len(lost := np.flatnonzero(out < 0)):
            lost = lost[self.crowded[where[lost]]]
            i = np.minimum(np.searchsorted(self.rest, key[lost]), len(self.rest) - 1)
            out[lost] = np.where(self.rest[i] == key[lost], self.rest_merged[i], -1)
        return out


def _drawn(seed: int, word: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """What an occurrence of a word brings to the hashes of its candidate merges."""
    return mixed(mixed(word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _key(seed)) + occurrence.astype(np.uint64))


def _code(at: np.ndarray, piece: np.ndarray) -> np.ndarray:
    return at << 20 | piece


def _dropped(dropout: float, drawn: np.ndarray, code: np.ndarray) -> np.ndarray:
    return (mixed(drawn + code.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) < dropout * 2.0**53


def skipped(seed: int, dropout: float, word: np.ndarray, occurrence: np.ndarray, at: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Whether a candidate merge is skipped: by a hash keyed with the seed, of the word, its occurrence, the place in it and the piece."""
    return _dropped(dropout, _drawn(seed, word, occurrence), _code(at.astype(np.int64), piece))


def word_hashes(symbols: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 63-bit hash for each word of symbols that stand one after the other."""
    if not len(size):
        return np.zeros(0, np.int64)
    each = mixed((symbols.astype(np.uint64) << np.uint64(24)) + _spread(np.zeros(len(size), np.int64), size).astype(np.uint64))
    return (mixed(np.add.reduceat(each, np.cumsum(size) - size)) >> np.uint64(1)).astype(np.int64)


def merged_alone(p: Pieces, symbols: np.ndarray, word: int, occurrence: int, seed: int, dropout: float) -> np.ndarray:
    """The agenda for one word: candidates leave it by rank, then place; skipped ones are dropped, the others merge."""
    n = len(symbols)
    sym, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def propose(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and after[i] < n]
        if not lefts:
            return
        a, b = np.array([sym[i] for i in lefts]), np.array([sym[after[i]] for i in lefts])
        new = p.look_up(a, b)
        place = np.array(lefts)
        drop = skipped(seed, dropout, np.full(len(place), word), np.full(len(place), occurrence), place, np.maximum(new, 0))
        for i, piece, no in zip(lefts, new.tolist(), drop.tolist(), strict=True):
            if piece >= 0 and not no:
                heapq.heappush(agenda, (int(p.rank[piece]), i, piece, sym[i], sym[after[i]]))

    propose(list(range(n - 1)))
    while agenda:
        _, i, piece, a, b = heapq.heappop(agenda)
        j = after[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue
        sym[i], sym[j], after[i] = piece, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        propose([before[i], i])
    return np.array([s for s in sym if s >= 0], np.int64)


def merged_in_step(p: Pieces, symbols: np.ndarray, lengths: np.ndarray, word: np.ndarray, occurrence: np.ndarray, seed: int, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """The agendas of many words at once: symbols left, and their number by word."""
    drawn = _drawn(seed, word, occurrence)
    return _in_step(p, symbols, lengths, lambda owner, code: _dropped(dropout, drawn[owner], code))


def _in_step(p: Pieces, symbols: np.ndarray, lengths: np.ndarray, skip: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """In each round every word's best candidate merges. skip is asked once for each candidate that comes up, by its word's
    number and its code. Words are at most LONG symbols, so a candidate is one number: its rank, then its place."""
    sym, owner, size = symbols.astype(np.int64), np.repeat(np.arange(len(lengths)), lengths), lengths.copy()
    at = np.arange(len(sym)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    words = np.arange(len(lengths))
    done_sym, done_owner = [], []

    def candidates(i: np.ndarray) -> np.ndarray:
        """The candidate of symbol i and the next; _NONE if there is none."""
        out = np.full(len(i), _NONE)
        inner = np.flatnonzero(owner[i] == owner[np.minimum(i + 1, len(sym) - 1)])
        inner = inner[i[inner] + 1 < len(sym)]
        k = i[inner]
        new = p.look_up(sym[k], sym[k + 1])
        found = np.flatnonzero(new >= 0)
        k, new = k[found], new[found]
        keep = np.flatnonzero(~skip(owner[k], _code(at[k], new)))
        out[inner[found[keep]]] = p.rank[new[keep]] << 8 | at[k[keep]]
        return out

    rank = candidates(np.arange(len(sym)))
    while len(sym):
        best = np.minimum.reduceat(rank, np.cumsum(size) - size)
        busy = best != _NONE
        if 2 * np.count_nonzero(busy) <= len(busy):  # put finished words aside, when they are many
            on = np.repeat(busy, size)
            done_sym.append(sym[~on])
            done_owner.append(owner[~on])
            sym, owner, at, rank = sym[on], owner[on], at[on], rank[on]
            words, size, best = words[busy], size[busy], best[busy]
            busy = np.ones(len(words), bool)
            if not len(sym):
                break
        hit = np.flatnonzero((rank == np.repeat(best, size)) & (rank != _NONE))
        sym[hit] = p.by_rank[rank[hit] >> 8]
        alive = np.ones(len(sym), bool)
        alive[hit + 1] = False
        hit = hit - np.arange(len(hit))  # a symbol goes for each hit before
        sym, owner, at, rank = sym[alive], owner[alive], at[alive], rank[alive]
        size[busy] -= 1
        changed = np.concatenate([hit, hit[hit > 0] - 1])
        rank[changed] = candidates(changed)
    if not done_sym:
        return sym, np.zeros(len(lengths), np.int64)
    all_owner = np.concatenate(done_owner)
    return np.concatenate(done_sym)[np.argsort(all_owner, kind="stable")], np.bincount(all_owner, minlength=len(lengths))


def _to_ids(p: Pieces, sym: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols without a piece become the pieces of their bytes."""
    out = np.flatnonzero(sym >= p.outside)
    if not len(out):
        return sym.astype(np.int32), count
    coded = [chr(c).encode() for c in (sym[out] - p.outside).tolist()]
    width = np.ones(len(sym), np.int64)
    width[out] = [len(c) for c in coded]
    ids = np.repeat(sym, width).astype(np.int32)
    starts = np.cumsum(width) - width
    where = np.repeat(starts[out], width[out]) + np.concatenate([np.arange(len(c)) for c in coded])
    ids[where] = p.byte[np.frombuffer(b"".join(coded), np.uint8)]
    owner = np.repeat(np.arange(len(count)), count)
    return ids, np.bincount(owner, width, len(count)).astype(np.int64)


class _Index(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type, fill: int = 0):
        self.fill, self.n = fill, 0
        self.all = np.full(1 << 12, fill, kind)

    def add(self, values: np.ndarray | int) -> None:
        """Appends values, or so many times fill."""
        end = self.n + (values if isinstance(values, int) else len(values))
        if end > len(self.all):
            self.all = np.concatenate([self.all, np.full(max(end, 2 * len(self.all)) - len(self.all), self.fill, self.all.dtype)])
        if not isinstance(values, int):
            self.all[self.n : end] = values
        self.n = end


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), begin[1], ..."""
    ends = np.cumsum(count)
    return np.repeat(begin - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes texts and remembers how it has cut words.

    Each occurrence has its own hashes; what is remembered doesn't depend on them. A cut of a word is known by the candidates
    skipped on the way to it. It lists the candidates that come up after the last of those, in order: an occurrence that
    skips none of them is cut so, one that skips some goes on to the cut in which the first of these is skipped as well."""

    def __init__(self, pieces: Pieces, seed: int = SEED, dropout: float = DROPOUT):
        self.pieces, self.seed, self.dropout = pieces, seed, dropout
        self._start()

    def _start(self) -> None:
        self.index = _Index()
        self.symbols, self.at, self.size, self.hash, self.seen = _Grown(np.int32), _Grown(np.int64), _Grown(np.int64), _Grown(np.int64), _Grown(np.int64)
        self.plain = _Grown(np.int32, -1)  # by word: its cut without skipped candidates
        # by cut: its word, the cut before (-1: none) and the candidate skipped since, candidates up to that one, its own ones, its ids
        self.word, self.before, self.without, self.passed = _Grown(np.int32), _Grown(np.int32), _Grown(np.int32), _Grown(np.int32)
        self.first, self.open, self.begin, self.count = _Grown(np.int64), _Grown(np.int32), _Grown(np.int64), _Grown(np.int32)
        self.code, self.next = _Grown(np.int32), _Grown(np.int32, -1)  # by candidate of a cut: the cut that skips it
        self.flat = _Grown(np.int32)

    def _learn(self, words: list[str]) -> None:
        size = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.pieces.first[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        self.at.add(self.symbols.n + np.cumsum(size) - size)
        self.symbols.add(symbols)
        self.size.add(size)
        self.hash.add(word_hashes(symbols, size))
        self.seen.add(len(words))
        self.plain.add(len(words))

    def _forget(self) -> None:
        """Keeps words seen often, with their cuts; none if that is most of them."""
        n, cuts = len(self.index), self.word.n
        often = self.seen.all[:n] >= OFTEN
        kept, stays = np.flatnonzero(often), np.flatnonzero(often[self.word.all[:cuts]])
        old, words = dict(self.__dict__), list(self.index)
        self._start()
        if 2 * len(kept) > n or 2 * len(stays) > CUTS:
            return
        self.index.update((words[i], k) for k, i in enumerate(kept.tolist()))
        self._learn(list(self.index))
        self.seen.all[: len(kept)] = old["seen"].all[kept]
        # a last place that -1 finds
        number = np.full(cuts + 1, -1, np.int32)
        number[stays] = np.arange(len(stays))
        new_word = np.cumsum(often) - 1
        self.plain.all[: len(kept)] = number[old["plain"].all[kept]]
        was = {name: old[name].all[stays] for name in ("word", "before", "without", "passed", "first", "open", "begin", "count")}
        self.word.add(new_word[was["word"]])
        self.before.add(number[was["before"]])
        for name in ("without", "passed", "open", "count"):
            getattr(self, name).add(was[name])
        self.first.add(np.cumsum(was["open"], dtype=np.int64) - was["open"])
        self.begin.add(np.cumsum(was["count"], dtype=np.int64) - was["count"])
        slots = _spread(was["first"], was["open"])
        self.code.add(old["code"].all[slots])
        self.next.add(number[old["next"].all[slots]])
        self.flat.add(old["flat"].all[_spread(was["begin"], was["count"])])

    def _symbols(self, word: np.ndarray) -> np.ndarray:
        return self.symbols.all[_spread(self.at.all[word], self.size.all[word])]

    def _cut(self, word: np.ndarray, before: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """New cuts: of words, or (slot) with a further candidate skipped. The cuts before have skipped equally many."""
        without = np.full(len(word), -1, np.int32)
        passed, skips = np.zeros(len(word), np.int64), []
        if len(slot):
            without, passed = self.code.all[slot], self.passed.all[before] + slot - self.first.all[before] + 1
            skips, up = [without], before
            while self.before.all[up[0]] >= 0:
                skips.append(self.without.all[up])
                up = self.before.all[up]
        owners, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def skip(owner: np.ndarray, code: np.ndarray) -> np.ndarray:
            owners.append(owner)
            codes.append(code)
            out = np.zeros(len(code), bool)
            for s in skips:
                out |= s[owner] == code
            return out

        ids, count = _to_ids(self.pieces, *_in_step(self.pieces, self._symbols(word), self.size.all[word], skip))
        owner = np.concatenate(owners)
        came = np.bincount(owner, minlength=len(word))
        code = np.concatenate(codes)[np.argsort(owner, kind="stable")][_spread(np.cumsum(came) - came + passed, came - passed)]
        new = np.arange(self.word.n, self.word.n + len(word))
        self.first.add(self.code.n + np.cumsum(came - passed) - (came - passed))
        self.begin.add(self.flat.n + np.cumsum(count) - count)
        for own, values in ((self.word, word), (self.before, before), (self.without, without), (self.passed, passed), (self.open, came - passed), (self.count, count), (self.code, code), (self.flat, ids)):
            own.add(values)
        self.next.add(len(code))
        if len(slot):
            self.next.all[slot] = new
        else:
            self.plain.all[word] = new
        return new

    def _known(self, place: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """The cut of each occurrence, by its word's number and what it draws; -1 where it isn't worth remembering."""
        out = np.full(len(place), -1, np.int64)
        on = np.flatnonzero((self.size.all[place] <= SHORT) & (self.seen.all[place] >= OFTEN))
        words = np.unique(place[on])
        words = words[self.plain.all[words] < 0]
        for a in range(0, len(words), IN_STEP):
            self._cut(part := words[a : a + IN_STEP], np.full(len(part), -1), part[:0])
        cut, depth = self.plain.all[place[on]], 0
        while len(on):
            n = self.open.all[cut]
            own, slots = np.repeat(np.arange(len(on)), n), _spread(self.first.all[cut], n)
            hits = np.flatnonzero(_dropped(self.dropout, drawn[on][own], self.code.all[slots]))
            of = own[hits]
            foremost = np.flatnonzero(np.diff(of, prepend=-1))
            of, slot = of[foremost], slots[hits[foremost]]
            out[on] = cut
            on, before, depth = on[of], cut[of], depth + 1
            out[on] = -1
            if depth <= DEEPEST and len(on):
                new, at, times = np.unique(slot[(lost := self.next.all[slot] < 0)], return_index=True, return_counts=True)
                at = np.flatnonzero(lost)[at]
                worth = (times > 1) | (self.seen.all[place[on[at]]] >= 4 * OFTEN)
                new, at = new[worth], at[worth]
                for a in range(0, len(new), IN_STEP):
                    part = at[a : a + IN_STEP]
                    self._cut(place[on[part]], before[part], new[a : a + IN_STEP])
            cut = self.next.all[slot]
            on, cut = on[cut >= 0], cut[cut >= 0]
        return out

    def encode(self, keys: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts, one after the other, and how many each has. keys: a number for each text; it and the place of
        a word are its occurrence."""
        if len(self.index) > REMEMBERED or self.word.n > CUTS:
            self._forget()
        number, known = self.index.__getitem__, len(self.index)
        found = [_WORDS.findall(text) for text in texts]
        n_words = np.fromiter(map(len, found), np.int64, len(found))
        place = np.fromiter(map(number, itertools.chain.from_iterable(found)), np.int64, n_words.sum())
        if not len(place):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        self._learn(list(itertools.islice(self.index, known, None)))
        self.seen.all[: len(self.index)] += np.bincount(place, minlength=len(self.index))
        base = mixed(np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64) + _key(self.seed))
        occurrence = mixed(np.repeat(base, n_words) + _spread(np.zeros(len(n_words), np.int64), n_words).astype(np.uint64))
        hashed, parts = self.hash.all[place], []
        for a in range(0, len(place), AT_ONCE):
            b = a + AT_ONCE
            parts.append(self._encoded(place[a:b], hashed[a:b], occurrence[a:b]))
        ids, n = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        ends = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(n_words)])])

    def _encoded(self, place: np.ndarray, hashed: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of occurrences of words, by the words' numbers and hashes, and how many each has."""
        cut = self._known(place, _drawn(self.seed, hashed, occurrence))
        begin, n = self.begin.all[cut], self.count.all[cut].astype(np.int64)
        rest, held = np.flatnonzero(cut < 0), self.flat.n
        size = self.size.all[place[rest]]
        short, long = rest[size <= LONG], rest[size > LONG]
        parts = []
        for a in range(0, len(short), IN_STEP):
            own = short[a : a + IN_STEP]
            parts.append((own, *merged_in_step(self.pieces, self._symbols(place[own]), self.size.all[place[own]], hashed[own], occurrence[own], self.seed, self.dropout)))
        for i in long.tolist():
            sym = merged_alone(self.pieces, self._symbols(place[i : i + 1]).astype(np.int64), int(hashed[i]), int(occurrence[i]), self.seed, self.dropout)
            parts.append((np.array([i]), sym, np.array([len(sym)])))
        for own, sym, count in parts:
            ids, count = _to_ids(self.pieces, sym, count)
            begin[own], n[own] = self.flat.n + np.cumsum(count) - count, count
            self.flat.add(ids)
        ids = self.flat.all[_spread(begin, n)]
        self.flat.n = held
        return ids, n


def decode_ids(p: Pieces, ids: np.ndarray) -> str:
    return b"".join(map(p.bytes.__getitem__, ids.tolist())).decode()


@lru_cache(2)
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, seed: int = SEED, dropout: float = DROPOUT, check: bool = False
) -> DataFrame:
    """docs with a column ids (array<int>): each whole text as piece ids under merge-dropout; an older column ids goes. With
    check there is also lossless: whether the ids decode to the text (null: empty) as it was.

    Every candidate merge that comes up in a word's agenda is skipped by a keyed hash with probability dropout, for each
    occurrence of the word by itself. The same seed, id and text give the same ids, however rows are dealt to tasks. Null and
    empty texts have no ids. Rows with null ids differ by their texts. Repeated rows are encoded alike. No rows give no rows. All other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(_model(model))  # half a megabyte
    kept = docs.drop("ids", *["lossless"] * check)
    names = kept.columns
    id_at, text_at = names.index(id_col), names.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given_back()  # what tasks of other operators have left in this worker
        encoder, rounds = Encoder(_pieces(shared.value), seed, dropout), 0
        for batch in batches:
            key, text = batch.column(id_at), batch.column(text_at)
            first, held, texts = 0, 0, []
            for i in range(batch.num_rows):  # some documents at a time, so that only their ids are held
                texts.append(text[i].as_py() or "")
                held += len(texts[-1])
                if held < TOGETHER and i + 1 < batch.num_rows:
                    continue
                own = batch.slice(first, len(texts))
                ids_here = key.slice(first, len(texts)).to_pylist()
                keys = [xxhash.xxh64_intdigest(t, xxhash.xxh64_intdigest("" if k is None else str(k), 0)) for k, t in zip(ids_here, texts, strict=True)]
                ids, counts = encoder.encode(keys, texts)
                ends = np.cumsum(counts)
                out = [*own.columns, pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids)]
                if check:
                    out.append(pa.array([decode_ids(encoder.pieces, x) == t for x, t in zip(np.split(ids, ends[:-1]), texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(out, [*names, "ids", *["lossless"] * check])
                first, held, texts, rounds = i + 1, 0, [], rounds + 1
                if rounds % 4 == 0:
                    given_back()
        del encoder  # what it remembers is as large as the rest of a worker
        given_back()

    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), *[T.StructField("lossless", T.BooleanType())] * check])
    return kept.toDF(*[f"_{i}" for i in range(len(names))]).mapInArrow(rows, schema)  # any column name will do


def decoded(ids: Column, spark_context, model: str = MODEL) -> Column:
    """The text that ids stand for."""
    shared = spark_context.broadcast(_model(model))

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        p = _pieces(shared.value)
        return pa.array([decode_ids(p, x.values.to_numpy()) if x.is_valid else None for x in ids], pa.string())

    return text_of(ids)


def encoded_and_checked(docs: DataFrame) -> DataFrame:
    """doc_id, ids, n_ids and lossless: whether ids decode to the text (null: empty) as it was."""
    out = encode(docs.select("doc_id", "text"), check=True)
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "lossless")
