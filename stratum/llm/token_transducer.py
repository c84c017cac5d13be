"""Token counts by a finite-state tokenizer.

A byte-pair vocabulary in which any neighbours merge whose concatenation is a piece, best score first, tokenizes a
text in the only way in which each two neighbouring tokens are stable together: merging their characters gives the
same two tokens again. That makes tokenizing regular. ``Transducer`` reads characters; its state holds, for each
start from which a piece may still grow, the place in the trie of pieces, the token before that start, and how many
tokens fewer the text had there. A transition is annotated with the tokens it emits: the count of the text read so
far, less the count before (it can be negative where a longer piece replaces shorter ones).

Two characters that stand together in no piece never share a token. There the transducer starts anew, so most chunks
of a text map every entry state to one exit state. Texts are cut into chunks that step in parallel. No maps are
built or composed: speculation with repair takes the place of a prefix scan. Each chunk is run from a guessed entry
state, and again where its predecessor's exit differs; without fresh starts that can go on chunk after chunk. States and transitions are made when first met, and dropped together when
there are too many, so memory is bounded.

Defined results: a NULL text counts as an empty one (no bytes, no tokens). Any length of text is counted whole, with
bounded memory beside the text itself. Repeated rows and ids each get a row; an empty table gives none. Columns other
than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame

from stratum.llm.common import mapped_slices

SPACE = "▁"
CHUNK = 256
#: Characters stepped at once.
BLOCK = 1 << 20
#: States kept at most, 4 bytes for each class of characters each (200 MB for 258 classes). Making them costs far more than
#: stepping: texts of 25 million characters need 140,000, and the number grows ever more slowly.
MOST_STATES = 200_000
#: Bits of a transition that hold the tokens it emits, in excess of half their range.
EMITTED = 10


@dataclasses.dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, and whether the text gets a leading space."""

    scores: dict[str, float]
    leading_space: bool = True

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a sentencepiece file of byte-pair pieces with byte fallback and the identity as normalizer."""
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as file:
            content = file.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(content)
        normalizer = proto.normalizer_spec
        if (proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback
                or normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces
                or not normalizer.escape_whitespaces or proto.denormalizer_spec.precompiled_charsmap):
            raise ValueError("needs byte-pair pieces, byte fallback and no normalization")
        if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in proto.pieces):
            raise ValueError("pieces of the user or out of use are not supported")
        model = SentencePieceProcessor(model_file=path)
        return Vocabulary({p.piece: p.score for p in proto.pieces if p.type == p.NORMAL},
                          model.encode("a", out_type=str)[0].startswith(SPACE))


def packed(state: int, emitted: int) -> int:
    """A transition's entry in the table."""
    excess = emitted + (1 << EMITTED - 1)
    if excess >> EMITTED:
        raise OverflowError("a transition emits too many tokens")
    return state << EMITTED | excess


class Transducer:
    ROOT = 0

    def __init__(self, vocabulary: Vocabulary, most_states: int = MOST_STATES, chunk: int = CHUNK):
        self.scores, self.leading_space = vocabulary.scores, vocabulary.leading_space
        self.most_states, self.chunk = most_states, chunk
        core = sorted({c for piece in self.scores if len(piece) > 1 for c in piece})
        if any(c not in self.scores for c in core):
            raise ValueError("a character of a piece is no piece itself")
        self.classes = len(core)  # the class after the last one is of all other characters
        class_of = {c: i for i, c in enumerate(core)}
        self.class_of = np.full(0x110000, self.classes, dtype=np.int16)
        #: tokens of a character that joins no other: its bytes, or one if it is a piece
        self.cost = np.full(0x110000, 4, dtype=np.int8)
        self.cost[:0x10000], self.cost[:0x800], self.cost[:0x80] = 3, 2, 1
        for piece in self.scores:
            if len(piece) == 1:
                self.cost[ord(piece)] = 1
        for c, i in class_of.items():
            self.class_of[ord(c)], self.cost[ord(c)] = i, 0
        self.adjacent = np.zeros((self.classes + 1, self.classes + 1), dtype=bool)
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[str | None] = [None]
        for piece in self.scores:
            if len(piece) == 1 and piece not in class_of:
                continue
            codes = [class_of[c] for c in piece]
            self.adjacent[codes[:-1], codes[1:]] = True
            node = 0
            for code in codes:
                below = self.children[node].get(code)
                if below is None:
                    below = self.children[node][code] = len(self.children)
                    self.children.append({})
                    self.token_at.append(None)
                node = below
            self.token_at[node] = piece
        self.stable: dict[tuple[str | None, str], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.keys: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        #: by state and class: the state after, and the emitted tokens in the last bits; -1 where not made yet
        self.table = np.empty((1024, self.classes + 1), dtype=np.int32)
        self._state(((0, None, 0),))

    def _state(self, key: tuple) -> int:
        number = self.ids.get(key)
        if number is None:
            number = self.ids[key] = len(self.keys)
            self.keys.append(key)
            if number == len(self.table):
                # Rows that no state has yet stay untouched, and take no memory.
                table = np.empty((2 * number, self.classes + 1), dtype=np.int32)
                table[:number] = self.table
                self.table = table
            self.table[number] = -1
            self.table[number, self.classes] = packed(self.ROOT, 0)
        return number

    def merged(self, text: str) -> list[str]:
        """The byte-pair tokens of a short text, by definition."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stands(self, before: str | None, token: str) -> bool:
        found = self.stable.get((before, token))
        if found is None:
            wanted = [token] if before is None else [before, token]
            found = self.merged("".join(wanted)) == wanted
            if len(self.stable) > 20 * self.most_states:
                self.stable.clear()
            self.stable[before, token] = found
        return found

    def _transition(self, state: int, code: int) -> None:
        grown, token, emitted = [], None, 0
        for node, before, fewer in self.keys[state]:
            below = self.children[node].get(code)
            if below is None:
                continue
            piece = self.token_at[below]
            if piece is not None and token is None and self._stands(before, piece):
                token, emitted = piece, fewer + 1
            if self.children[below]:
                grown.append((below, before, fewer))
        if token is None:
            raise AssertionError("no stable token ends here")
        key = (*((node, before, fewer - emitted) for node, before, fewer in grown), (0, token, 0))
        target = self._state(key)
        self.table[state, code] = packed(target, emitted)

    def _step(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States before (renumbered if the table was dropped), states after and emitted counts."""
        found = self.table[states, codes]
        missing = np.flatnonzero(found < 0)
        if len(missing):
            if len(self.keys) > self.most_states:
                distinct, at = np.unique(states, return_inverse=True)
                keys = [self.keys[i] for i in distinct]
                self._reset()
                states = np.array([self._state(k) for k in keys], dtype=np.int32)[at]
                missing = np.arange(len(states))
            width = self.classes + 1
            for flat in np.unique(states[missing].astype(np.int64) * width + codes[missing]):
                state, code = divmod(int(flat), width)
                if self.table[state, code] < 0:
                    self._transition(state, code)
            found = self.table[states, codes]
        return states, found >> EMITTED, (found & (1 << EMITTED) - 1) - (1 << EMITTED - 1)

    def _chunks(self, codes: np.ndarray, fresh: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                entries: list[tuple]) -> tuple[list[tuple], np.ndarray]:
        """Step the given chunks from the given entry states: exit states (as keys) and counts."""
        order = np.argsort(-lengths, kind="stable")
        begin, length = starts[order], lengths[order]
        states = np.array([self._state(entries[i]) for i in order], dtype=np.int32)
        counts = np.zeros(len(order), dtype=np.int64)
        exits: list = [None] * len(order)
        alive = len(order)
        for j in range(int(length[0]) if len(length) else 0):
            left = int(np.searchsorted(-length, -j, side="left"))  # chunks longer than j
            for i in range(left, alive):
                exits[order[i]] = self.keys[states[i]]
            alive = left
            at = begin[:alive] + j
            before = np.where(fresh[at], self.ROOT, states[:alive])
            _, after, emitted = self._step(before, codes[at])
            states = after
            counts[:alive] += emitted
        for i in range(alive):
            exits[order[i]] = self.keys[states[i]]
        back = np.empty_like(counts)
        back[order] = counts
        return exits, back

    def run(self, codes: np.ndarray, fresh: np.ndarray, entry: tuple,
            firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Chunk starts, tokens emitted in each chunk, exit state. ``fresh``: here the transducer starts anew."""
        size = len(codes)
        points = np.flatnonzero(fresh)
        goals = np.arange(0, size, self.chunk)
        at = np.searchsorted(points, goals)
        near = np.where(at < len(points), points[np.minimum(at, len(points) - 1)] if len(points) else size, size)
        # The next fresh start, if it is within a chunk's length; else a cut in a run, whose entry state is not known.
        starts = np.unique(np.concatenate([[0], np.where(near - goals < self.chunk, near, goals), firsts]))
        starts = starts[starts < size]
        lengths = np.diff(np.append(starts, size))
        root = ((0, None, 0),)
        entries = [root] * len(starts)
        entries[0] = entry
        exits, counts = self._chunks(codes, fresh, starts, lengths, entries)
        while True:
            wrong = [i for i in range(1, len(starts)) if not fresh[starts[i]] and entries[i] != exits[i - 1]]
            if not wrong:
                return starts, counts, exits[-1]
            for i in wrong:
                entries[i] = exits[i - 1]
            again, numbers = self._chunks(codes, fresh, starts[wrong], lengths[wrong], [entries[i] for i in wrong])
            for i, out, number in zip(wrong, again, numbers):
                exits[i], counts[i] = out, number

    def _codes(self, text: str) -> np.ndarray:
        return np.frombuffer(text.replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def _block(self, points: np.ndarray, previous: int | None, entry: tuple,
               firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        codes = self.class_of[points]
        fresh = np.empty(len(codes), dtype=bool)
        fresh[1:] = ~self.adjacent[codes[:-1], codes[1:]]
        fresh[0] = previous is None or not self.adjacent[previous, codes[0]]
        fresh[firsts] = True
        return (*self.run(codes, fresh, entry, firsts), codes)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        totals = [0] * len(texts)
        batch: list[int] = []
        size = 0
        root = ((0, None, 0),)

        def flush() -> None:
            nonlocal batch, size
            if batch:
                arrays = [self._codes(self._opened(texts[i])) for i in batch]
                firsts = np.cumsum([0, *map(len, arrays)])[:-1]
                points = np.concatenate(arrays)
                starts, counts, _, _ = self._block(points, None, root, firsts)
                owner = np.searchsorted(firsts, starts, side="right") - 1
                sums = np.bincount(owner, weights=counts, minlength=len(batch)).astype(np.int64)
                sums += np.add.reduceat(self.cost[points].astype(np.int64), firsts)
                for i, n in zip(batch, sums):
                    totals[i] = int(n)
            batch, size = [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            if len(text) > BLOCK:
                totals[i] = self._long(self._opened(text))
                continue
            batch.append(i)
            size += len(text)
            if size > BLOCK:
                flush()
        flush()
        return totals

    def _opened(self, text: str) -> str:
        return SPACE + text if self.leading_space else text

    def _long(self, text: str) -> int:
        total, previous, entry = 0, None, ((0, None, 0),)
        for start in range(0, len(text), BLOCK):
            points = self._codes(text[start:start + BLOCK])
            _, counts, entry, codes = self._block(points, previous, entry, np.array([], dtype=np.int64))
            total += int(counts.sum()) + int(self.cost[points].sum(dtype=np.int64))
            previous = int(codes[-1])
        return total


_compiled: dict[int, Transducer] = {}


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """Bytes and tokens of each row's text by the vocabulary file ``model``, which only the driver reads."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))  # fixed size: that of the file
    key = hash((model, len(shared.value.scores)))

    def counted(columns: list[list]) -> Iterable[tuple]:
        if key not in _compiled:
            _compiled[key] = Transducer(shared.value)
        ids, texts = columns
        texts = [t or "" for t in texts]
        for doc_id, text, n in zip(ids, texts, _compiled[key].count(texts)):
            yield doc_id, len(text.encode("utf-8", "surrogatepass")), n, n > limit

    return mapped_slices(docs.selectExpr("cast(doc_id as long) doc_id", "text"),
                         "doc_id long, n_bytes long, n_tokens long, over_limit boolean", counted)
