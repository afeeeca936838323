"""Exact merge-type encoding with a sentencepiece BPE model, by backtracking; and counts by a heap of merges.

The result of merging is the only row of pieces in which every two neighbours stay apart when their joined
string is merged on its own. So the encoder takes longest matches, checks each pair of neighbours by
re-merging, steps back to a shorter match or an earlier piece when a check fails, and keeps one bit for each
position from which no row of pieces can go on.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain
from operator import add

import ahocorasick

SPACE = "▁"
#: Entries of one generation of a cache of words or of pairs of pieces; two generations are kept, so memory is bounded.
CACHE, PAIR_CACHE = 150_000, 300_000
#: Characters of the longest word that is kept in a cache.
LONGEST = 32


class Recent(dict):
    """A mapping of two generations: the older is dropped when the younger is full. Long words are worked out anew each time."""

    def __init__(self, make, limit: int = CACHE):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if type(key) is str and len(key) > LONGEST:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _chained(parts: list[tuple[int, ...]]) -> tuple[int, ...]:
    return tuple(chain.from_iterable(parts))


class PieceModel:
    """Pieces, scores and byte pieces of a model file, and encoding, decoding and counting with them."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(size)]
        self.eos = library.eos_id()
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(size) if library.is_control(i)}
        plain = [i for i in range(size) if not (library.is_control(i) or library.is_byte(i) or library.is_unknown(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: library.get_score(i) for i in plain}
        self.unknown = library.unk_id()
        self.size = size
        # No piece may join the end of a word to the space before the next one: then words can be merged one by one.
        self.split_words = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.chunk = re.compile(" *[^ \n]+|\n| +" if "\n" not in "".join(self.ids) else " *[^ ]+| +")
        self.newline_free = "\n" not in "".join(self.ids)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) == 1 or self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        #: The longest piece that a piece begins with, besides itself: what a failed match is replaced with.
        self.shorter: dict[int, tuple[int, int] | None] = {}
        for piece in self.automaton.keys():
            prefixes = (piece[:k] for k in range(len(piece) - 1, 0, -1))
            self.shorter[self.ids[piece]] = next((self.automaton.get(p) for p in prefixes if p in self.automaton), None)
        self.longest = max(map(len, self.automaton.keys()), default=1)
        self.single = frozenset(p for p in self.ids if len(p) == 1)
        self.rank = {p: -s for p, s in self.score.items()}
        self.apart = Recent(self._apart, PAIR_CACHE)
        # Nor may one join a letter to another kind of character, but for the space before a word.
        mixed = (p.lstrip(SPACE) for p in self.ids)
        self.split_kinds = not any(a.isalpha() != b.isalpha() for p in mixed for a, b in zip(p, p[1:], strict=False))
        self.word_ids = Recent(lambda w: self._by_runs(w, SPACE + w, self.backtrack, self.word_ids, self.head_ids, _chained))
        self.head_ids = Recent(lambda w: self._by_runs(w, w.replace(" ", SPACE), self.backtrack, self.head_ids, self.head_ids, _chained))
        self.word_count = Recent(lambda w: self._by_runs(w, SPACE + w, self.merge_count, self.word_count, self.head_count, sum))
        self.head_count = Recent(lambda w: self._by_runs(w, w.replace(" ", SPACE), self.merge_count, self.head_count, self.head_count, sum))
        self.shown = [str(i) for i in range(size)]
        self.plain_text = [p.replace(SPACE, " ") for p in self.pieces]
        for i in self.silent:
            self.plain_text[i] = ""
        self.plain_text[self.unknown] = library.decode([self.unknown])

    def _by_runs(self, word: str, marked: str, whole, first: Recent, rest: Recent, join):
        """`whole` of a word of letters only or of none; else the sum over its runs of either, the first one with the space before it."""
        bare = word.lstrip(" ")
        if not self.split_kinds or not bare or bare.isalpha():
            return whole(marked)
        begin, at = 0, len(word) - len(bare)
        kind, parts = word[at].isalpha(), []
        for k in range(at + 1, len(word)):
            if word[k].isalpha() != kind:
                parts.append((rest if parts else first)[word[begin:k]])
                begin, kind = k, not kind
        return join([*parts, rest[word[begin:]]]) if parts else whole(marked)

    def merged(self, text: str) -> list[str]:
        """The pieces of `text` after all merges, best score first and leftmost first among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, k
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _apart(self, pair: int) -> bool:
        """Whether two neighbouring pieces are still these two after re-merging their joined string."""
        left, right = self.pieces[pair // self.size], self.pieces[pair % self.size]
        return self.merged(left + right) == [left, right]

    def backtrack(self, text: str) -> tuple[int, ...]:
        """Ids of `text`, whose spaces are already marked. Characters without a piece become their bytes' pieces."""
        if self.single.issuperset(text):
            return tuple(self._row(text))
        out: list[int] = []
        begin = 0
        for k, c in enumerate(text):  # characters without a piece never merge: they cut the text
            if c not in self.single:
                out += self._row(text[begin:k])
                out += [self.bytes.get(b, self.unknown) for b in c.encode("utf-8", "surrogatepass")]
                begin = k + 1
        return tuple(out + self._row(text[begin:]))

    def _row(self, text: str) -> list[int]:
        """Ids of a text of characters that are pieces themselves, so that some piece begins everywhere."""
        size, apart, shorter, longest, end = self.size, self.apart, self.shorter, self.longest, len(text)
        ids: list[int] = []
        ends: list[int] = []
        at = 0
        for _, (i, length) in self.automaton.iter_long(text):  # longest matches one after another
            if ids and not apart[ids[-1] * size + i]:
                match: tuple[int, int] | None = shorter[i]
                break
            ids.append(i)
            at += length
            ends.append(at)
        else:
            return ids
        failed = bytearray(end // 8 + 1)  # bit k: from position k no row of pieces reaches the end
        while at < end:
            while match is not None:
                i, length = match
                to = at + length
                if not failed[to >> 3] >> (to & 7) & 1 and (not ids or apart[ids[-1] * size + i]):
                    break
                match = shorter[i]
            if match is not None:
                ids.append(i)
                ends.append(to)
                at = to
                match = next(self.automaton.iter_long(text[at : at + longest]))[1] if at < end else None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                match = shorter[ids.pop()]
                ends.pop()
                at = ends[-1] if ends else 0
        return ids

    def chunks(self, text: str):
        """(word, whether a space stands before it) for each part of the text that merges on its own."""
        if not self.split_words:
            yield " " + text, False
            return
        for part in self.chunk.findall(" " + text):
            if part[0] == " " and part[1:2] not in (" ", ""):
                yield part[1:], True
            else:
                yield part, False

    def encode(self, text: str) -> list[int]:
        """Ids without the end id; an empty text has none."""
        out: list[int] = []
        if not text:
            return out
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if self.split_words and self.newline_free and "  " not in text:
            word_ids, head_ids = self.word_ids, self.head_ids
            marked = True  # the model puts a space before the text
            for line in text.split("\n"):
                words = line.split(" ")
                if "" in words[1:] or (marked and not words[0]):
                    break
                if not marked:
                    out += head_ids["\n"]
                    if words[0]:
                        out += head_ids[words[0]]
                    del words[0]
                marked = False
                for ids in map(word_ids.__getitem__, words):
                    out += ids
            else:
                return out
            out = []
        for word, spaced in self.chunks(text):
            out += self.word_ids[word] if spaced else self.head_ids[word]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids as the library gives it: one leading space off, bytes joined, bad bytes replaced."""
        byte_of = self.byte_of
        if byte_of.keys().isdisjoint(ids):
            text = "".join(map(self.plain_text.__getitem__, ids))
        else:
            parts, raw = [], bytearray()
            for i in ids:
                b = byte_of.get(i)
                if b is not None:
                    raw.append(b)
                    continue
                if raw:
                    parts.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                parts.append(self.plain_text[i])
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
            text = "".join(parts)
        return text[1:] if ids and text.startswith(" ") and self.pieces[ids[0]].startswith(SPACE) else text

    def merge_count(self, text: str) -> int:
        """Tokens of `text`: initial symbols less merges. No id is made."""
        score, n = self.rank, len(text)
        parts: list[str | None] = list(text)
        count = n
        if not self.single.issuperset(text):
            count = sum(1 if c in self.single else len(c.encode("utf-8", "surrogatepass")) for c in text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(s, k, pair) for k, pair in enumerate(map(add, text, text[1:])) if (s := score.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, joined = heapq.heappop(heap)
            if parts[left] is None or (right := after[left]) >= n or len(parts[left]) + len(parts[right]) != len(joined):
                continue  # one of the two has merged since
            parts[left], parts[right] = joined, None
            count -= 1
            after[left] = nxt = after[right]
            if nxt < n:
                before[nxt] = left
                if (s := score.get(joined + parts[nxt])) is not None:
                    heapq.heappush(heap, (s, left, joined + parts[nxt]))
            if (prev := before[left]) >= 0 and (s := score.get(parts[prev] + joined)) is not None:
                heapq.heappush(heap, (s, prev, parts[prev] + joined))
        return count

    def count(self, text: str) -> int:
        """Tokens of a whole text, without an end id."""
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if self.split_words and self.newline_free and "  " not in text:
            word_count, head_count = self.word_count, self.head_count
            total, marked = 0, True
            for line in text.split("\n"):
                words = line.split(" ")
                if "" in words[1:] or (marked and not words[0]):
                    break
                if not marked:
                    total += head_count["\n"] + (head_count[words[0]] if words[0] else 0)
                    del words[0]
                marked = False
                total += sum(map(word_count.__getitem__, words))
            else:
                return total
        return sum(self.word_count[word] if spaced else self.head_count[word] for word, spaced in self.chunks(text))


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, read once in each Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]
