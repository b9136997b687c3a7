"""Byte-level BPE by a lazily determinised transducer, and streaming decoding by an incremental UTF-8 machine.

The merges are compiled into two tables.  ``Transducer.fits``: a token may follow another if the two are the
encoding of their own concatenation; the encoding of a byte string is the only split into tokens in which all
neighbours fit.  And an automaton over bytes: a token may begin anywhere, so the automaton is in all the beginnings
of tokens that the bytes just read end with; this set of states is determinised, a set at a time, when a text first
needs it, and has as output the tokens that may end here.  The last token of each prefix is the one of these that
fits the last token of the prefix before it.  A later token can begin only where the set says so, thus what all
those places have in common behind them is settled and leaves the transducer: the lookahead is bounded by the
longest token.  Tables that grow beyond their bound are begun anew between pieces.

The work is one pass over the documents, without a shuffle; each Python worker builds its own tables.
"""
from __future__ import annotations

import base64
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, per_worker

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bounds of a worker's tables: states, checked token pairs, remembered pieces (and words) and their longest length.
STATES, PAIRS, MEMORY, LONG = 30_000, 500_000, 120_000, 48
#: Bytes of the beginnings that are remembered, and how many of them.
HEAD, HEADS = 5, 25_000
#: Prefixes of a piece that are held before the settled tokens leave.
WINDOW = 512
ROWS = 128


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """The ranks of a file of lines "base64 rank"; by default the public 50k vocabulary."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Transducer:
    """Encodes one piece at a time; see the module's text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for i, t in self.token.items()}
        # tokens that merges reach; an unreachable one can only be a piece by itself
        self.reachable = {t: i for t, i in ranks.items() if self.merge(t) == [i]}
        self.begins = {t[:k] for t in self.reachable for k in range(1, len(t))}
        self.fits: dict[int, dict[int, bool]] = {}  # right token: {left token: may it stand there}
        self.pairs = 0
        self._restart()

    def merge(self, text: bytes) -> list[int]:
        """The definition: join the neighbours of least rank, the leftmost first, until none can be joined."""
        rank, never = self.ranks.get, 1 << 60
        parts = [text[k:k + 1] for k in range(len(text))]
        joined = [rank(text[k:k + 2], never) for k in range(len(text) - 1)]
        while joined and (least := min(joined)) != never:
            k = joined.index(least)
            parts[k] += parts.pop(k + 1)
            del joined[k]
            if k:
                joined[k - 1] = rank(parts[k - 1] + parts[k], never)
            if k < len(joined):
                joined[k] = rank(parts[k] + parts[k + 1], never)
        return [self.ranks[p] for p in parts]

    def _restart(self) -> None:
        #: a state is known by the longest of its beginnings; it is (steps by byte, ends, that beginning)
        self.states: dict[bytes, tuple] = {b"": ({}, (), b"")}
        self.heads: dict[bytes, tuple] = {}

    def _fit(self, left: int | None, right: int) -> bool:
        """May ``right`` follow ``left``?  None: a prefix at which no token begins; -1: the beginning of the piece."""
        if left is None:
            return False
        a, b = self.token[left], self.token[right]
        self.pairs += 1
        if self.pairs > PAIRS:
            self.pairs = 1
            for known in self.fits.values():
                known.clear()
                known[-1] = True
        fit = self.fits[right][left] = a + b not in self.ranks and self.merge(a + b) == [left, right]
        return fit

    def _step(self, state: tuple, byte: int) -> tuple:
        """The state after ``byte``, with the tokens that may end there as (length, id, what it fits), longest first."""
        seen = state[2] + bytes((byte,))
        while seen not in self.begins and seen not in self.reachable:
            seen = seen[1:]
        after = self.states.get(seen)
        if after is None:
            ends = ((len(seen) - k, self.reachable.get(seen[k:])) for k in range(len(seen)))
            ends = tuple((size, token, self.fits.setdefault(token, {-1: True})) for size, token in ends if token is not None)
            after = self.states[seen] = {}, ends, seen
        state[0][byte] = after
        return after

    def piece(self, text: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES:
            self._restart()
        # many pieces begin alike: the walk starts behind a beginning that it has been over before
        head = text[:HEAD]
        begun = self.heads.get(head)
        if begun is None:
            if len(self.heads) >= HEADS:
                self.heads.clear()
            begun = self.heads[head] = self._walk(head, self.states[b""], [-1], [])
        state, last = begun
        out: list[int] = []
        _, last = self._walk(text[HEAD:], state, last.copy(), out)
        own, size, n = [], self.size, len(last) - 1
        while n:
            token = last[n]
            own.append(token)
            n -= size[token]
        return out + own[::-1]

    def _walk(self, text: bytes, state: tuple, last: list, out: list[int]) -> tuple[tuple, list]:
        """Read ``text`` on from ``state``; ``last`` has the last token of each prefix since the settled one."""
        for byte in text:
            try:
                state = state[0][byte]
            except KeyError:
                state = self._step(state, byte)
            for size, token, known in state[1]:
                try:
                    fit = known[last[-size]]
                except KeyError:
                    fit = self._fit(last[-size], token)
                if fit:
                    last.append(token)
                    break
            else:
                raise ValueError("the ranks lack a byte")
            if len(last) > WINDOW:
                last = self._settle(state[2], last, out)
        return state, last

    def _back(self, last: list, at: int) -> tuple[list[int], list[int]]:
        """The prefixes (by their place in ``last``) and the tokens on the way to prefix ``at``, in order."""
        places, tokens, size = [at], [], self.size
        while at:
            token = last[at]
            tokens.append(token)
            at -= size[token]
            places.append(at)
        return places[::-1], tokens[::-1]

    def _settle(self, seen: bytes, last: list, out: list[int]) -> list:
        """Emit what the ways to all places where a token may still begin have in common; the rest of ``last``."""
        end = len(last) - 1
        starts = [end] + [end - len(seen) + k for k in range(len(seen)) if seen[k:] in self.begins]
        ways = [self._back(last, at) for at in starts if at >= 0 and last[at] is not None]
        common = 0
        least = min(len(tokens) for _, tokens in ways)
        while common < least and len({(places[common + 1], tokens[common]) for places, tokens in ways}) == 1:
            common += 1
        out += ways[0][1][:common]
        base = ways[0][0][common]
        # prefixes that no way passes through can lead before the settled one; no token will begin there
        used = {p for places, _ in ways for p in places}
        return [last[p] if p in used else None for p in range(base, len(last))]


class Memory(dict):
    """``make(key)`` by key, remembered; what was not asked for since the last ``MEMORY`` new keys is forgotten."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONG:
            if len(self) >= MEMORY:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Cuts texts into pieces and encodes them; words with what sticks to them are remembered.

    Ids are packed as unsigned 32-bit integers in the machine's byte order."""

    def __init__(self, ranks: dict[bytes, int]):
        import public_tokenizers
        import regex
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # A space before another character than white space always begins a piece, and what stands before it is cut
        # the same without it: a text may be cut there first.  Not so at other spaces.
        self.other_space = regex.compile(r" (?:\s|$)")
        self.pieces, self.words = Memory(self._piece), Memory(self._word)

    def _piece(self, piece: str) -> bytes:
        return array("I", self.transducer.piece(piece.encode())).tobytes()

    def _word(self, word: str) -> bytes:
        """A space and ``word``, which begins with no white space."""
        if word.isalpha():  # letters are one piece
            return self._piece(" " + word)
        if word[:-1].isalpha() and word[-1] in ",.;:!?":
            return self.words[word[:-1]] + self.pieces[word[-1]]
        return self._cut(" " + word)

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        """The packed ids of a text."""
        if len(text) >= 1 << 20:  # one piece at a time
            return b"".join(self.pieces[m.group()] for m in self.pattern.finditer(text))
        if self.other_space.search(text):
            return self._cut(text)
        first, *rest = text.split(" ")
        return self._cut(first) + b"".join(map(self.words.__getitem__, rest))


class Decoder:
    """Tokens to text, one token at a time: characters leave as soon as their last byte is there.

    The state is the beginning of a character, at most three bytes.  Bytes that belong to no character become
    U+FFFD, one for each longest beginning of a character."""

    def __init__(self, token: dict[int, bytes]):
        self.token, self.steps = token, {b"": {}}

    @staticmethod
    def follows(begun: bytes) -> tuple[int, int, int]:
        """(bytes still missing, least and greatest next byte) of the beginning of a character; missing < 0: no character."""
        lead = begun[0]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        low, high = 0x80, 0xBF
        if len(begun) == 1:  # no overlong forms, no surrogates, nothing beyond U+10FFFF
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
        return size - len(begun), low, high

    def _step(self, begun: bytes, token: int) -> tuple[str, bytes]:
        out = []
        start = begun
        for byte in self.token[token]:
            if begun:
                _, low, high = self.follows(begun)
                if not low <= byte <= high:
                    out.append("�")
                    begun = b""
            begun += bytes((byte,))
            missing = self.follows(begun)[0]
            if missing < 0:
                out.append("�")
                begun = b""
            elif not missing:
                out.append(begun.decode())
                begun = b""
        step = self.steps.setdefault(start, {})[token] = "".join(out), begun
        return step

    def decode(self, ids) -> str:
        out, begun, steps = [], b"", self.steps
        here = steps[b""]
        for i in ids:
            text, after = here.get(i) or self._step(begun, i)
            if text:
                out.append(text)
            if after != begun:
                begun = after
                here = steps.setdefault(begun, {})
        return "".join(out) + ("�" if begun else "")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           packed: bool = False) -> DataFrame:
    """(doc_id, ids) for each row of ``docs``: the ids of the whole text as the ranks and the public split pattern give
    them, special tokens being ordinary text.  Null and empty texts have no ids.  Repeated rows are encoded each.
    ``packed``: the ids as binary, little-endian unsigned 32-bit integers, instead of an array."""
    def run(frames):
        coder = per_worker(("bpe", ranks_path), lambda: Encoder(read_ranks(ranks_path)))
        for b in batches_of(frames, ROWS):
            rows = [coder.encode(text) if text else b"" for text in b.column(1).to_pylist()]
            if packed:
                ids = pa.array([np.frombuffer(r, np.uint32).astype("<u4").tobytes() for r in rows], pa.binary())
            else:
                ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, ids {'binary' if packed else 'array<int>'}")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """(doc_id, ids, text) for each row: the text of the ids, an array or packed; null ids are none.  Unknown ids are an
    error."""
    packed = encoded.schema[ids_col].dataType.simpleString() == "binary"

    def run(frames):
        token = per_worker(("tokens", ranks_path), lambda: {i: t for t, i in read_ranks(ranks_path).items()})
        machine = per_worker(("decoder", ranks_path), lambda: Decoder(token))
        for b in batches_of(frames, ROWS):
            rows = (np.frombuffer(p or b"", "<u4").tolist() for p in b.column(1).to_pylist()) if packed else _rows(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(machine.decode, rows), pa.string())],
                                             names=["doc_id", "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    ids = F.col(ids_col) if packed else F.col(ids_col).cast("array<int>")
    return encoded.select(F.col(id_col).alias("doc_id"), ids.alias("ids")) \
        .mapInArrow(run, f"doc_id {kind}, ids {'binary' if packed else 'array<int>'}, text string")


def _rows(lists: pa.ListArray):
    """The rows of a list column as lists of integers, one at a time; null is empty."""
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield values[a:b].tolist()
