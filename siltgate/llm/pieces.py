"""Exact encoding and decoding with the merge vocabulary of a SentencePiece model.

The merges of a text are the only sequence of pieces in which every neighbouring pair is
what merging the two pieces' own text gives.  So the encoder never merges a whole text:
Aho-Corasick finds the longest piece that starts at each place, and a walk takes the
longest that is compatible with its left neighbour, then shorter prefixes; where none
fits, the place is marked as failed in a bitfield and the walk steps back.  A place fails
once, so the work is linear.  Whether two pieces are compatible is found by merging their
joined text, and remembered.

A piece that has no vocabulary entry, always a single character, becomes its bytes.
Text is cut before each run of spaces if no piece of the vocabulary goes on from another
character to a space, and words are cut between characters that stand side by side in no
piece: no merge crosses such a cut, and equal parts are encoded once.
Runs of spaces have pieces of equal rank, where the leftmost merge goes first; merging
them is not settled pair by pair, so what follows from ties is merged as a whole.

Nothing is cut off: any text is encoded in full.  NULL and empty texts have no tokens.
Repeated rows and NULL ids are rows like others.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import per_process, text_chunks

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Parts of words and pairs that a process remembers, and the longest word it remembers.
REMEMBERED, REMEMBERED_CHARS = 250_000, 48


class Merges:
    """Pieces with their scores, and the merges they make of a text."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        seen: set[float] = set()
        tied = {s for s in scores.values() if s in seen or seen.add(s)}
        self.tied = {p for p, s in scores.items() if s in tied and len(p) > 1}
        #: Those that hold no other one.
        self.least_tied = [p for p in self.tied if not any(q != p and q in p for q in self.tied)]

    def __call__(self, text: str) -> list[str]:
        """Join the neighbours with the best score, the leftmost first, until none is left."""
        return self._of_long(text) if len(text) > 64 else self._of_short(text)

    def _of_short(self, text: str) -> list[str]:
        parts, score, none = list(text), self.scores.get, -np.inf
        ranks = [score(a + b, none) for a, b in pairwise(parts)]
        while ranks and (best := max(ranks)) != none:
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = score(parts[k - 1] + parts[k], none)
            if k < len(ranks):
                ranks[k] = score(parts[k] + parts[k + 1], none)
        return parts

    def _of_long(self, text: str) -> list[str]:
        n = len(text)
        ends, after = list(range(1, n + 1)), list(range(1, n + 1))
        before, alive = list(range(-1, n - 1)), [True] * n
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            if a >= 0 and after[a] < n:
                score = self.scores.get(text[a : ends[after[a]]])
                if score is not None:
                    heapq.heappush(heap, (-score, a, ends[after[a]]))

        for a in range(n):
            offer(a)
        while heap:
            _, a, end = heapq.heappop(heap)
            if not alive[a] or after[a] >= n or ends[after[a]] != end:
                continue  # one of the two has been merged since
            b = after[a]
            alive[b], ends[a], after[a] = False, end, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(before[a])
            offer(a)
        return [text[a : ends[a]] for a in range(n) if alive[a]]


class Backtracker:
    """Splits a text into pieces as ``Merges`` does, without merging it."""

    def __init__(self, merges: Merges):
        import ahocorasick

        self.merges, self.known = merges, merges.scores
        self.automaton = ahocorasick.Automaton()
        for piece in self.known:
            self.automaton.add_word(piece, len(piece))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}

    def longest(self, text: str) -> list[int]:
        """Length of the longest piece that starts at each place; 1 where there is none."""
        out = [1] * len(text)
        if len(self.automaton):
            for end, size in self.automaton.iter(text):
                if size > out[end + 1 - size]:
                    out[end + 1 - size] = size
        return out

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the joined text gives these two back (``left`` may be empty)."""
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            found = self.merges(left + right) == ([left, right] if left else [right])
            self.pairs[key] = found
        return found

    def __call__(self, text: str) -> list[str]:
        longest, n, known = self.longest(text), len(text), self.known
        remembered, compatible = self.pairs.get, self.compatible
        open_at = bytearray(b"\xff" * (n // 8 + 1))  # one bit a place: not yet failed
        found: list[str] = []
        at, size, left = 0, longest[0] if n else 0, ""
        while at < n:
            while size:
                end = at + size
                right = text[at:end]
                if (right in known or size == 1) and open_at[end >> 3] >> (end & 7) & 1:
                    fits = remembered((left, right))
                    if fits if fits is not None else compatible(left, right):
                        break
                size -= 1
            if size:
                found.append(right)
                at, left = end, right
                size = longest[at] if at < n else 0
                continue
            open_at[at >> 3] &= ~(1 << (at & 7)) & 0xFF
            if not found:
                raise ValueError("merging is not settled by pairs in this vocabulary")
            size = len(found.pop())
            at -= size
            size -= 1  # that piece led to a place that fails
            left = found[-1] if found else ""
        return found


class Memory(dict):
    """What a function gives for short strings, for ``most`` to ``2 * most`` of them.

    When it is full it becomes the older half, from which what is asked for comes back.
    """

    def __init__(self, function, most: int):
        super().__init__()
        self.function, self.most, self.older = function, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
            if len(key) > REMEMBERED_CHARS:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceTable:
    """The pieces of a SentencePiece file with byte pieces, and what they stand for."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        kinds = [
            "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i)
            else "control" if model.is_control(i) else "unused" if model.is_unused(i) else "text"
            for i in range(n)
        ]
        if kinds.count("byte") != 256 or "unused" in kinds:
            raise ValueError(f"{path} is no merge model with byte pieces")
        self.kinds = kinds
        self.ids = {p: i for i, p in enumerate(self.names) if kinds[i] == "text"}
        self.byte_ids = [0] * 256
        #: What a token stands for in UTF-8; None for bytes and what has no text.
        self.raw: list[bytes] = [b""] * n
        for i, (name, kind) in enumerate(zip(self.names, kinds, strict=True)):
            if kind == "byte":
                self.raw[i] = bytes([int(name[3:5], 16)])
                self.byte_ids[self.raw[i][0]] = i
            elif kind == "text":
                self.raw[i] = name.replace(SPACE, " ").encode()


class PieceModel(PieceTable):
    """Encoder and decoder of a SentencePiece file of the merge type with byte pieces.

    It covers models that leave text as it is but for spaces (the identity normalizer with
    a space put before the text), as the file of the query does; ``tests/llm`` hold it
    against the library.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.merges = Merges({p: self.model.get_score(i) for p, i in self.ids.items()})
        self.split = Backtracker(self.merges)
        self.neighbours = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.of_part = Memory(self.encode_part, REMEMBERED)
        self.of_word = Memory(self.encode_word, REMEMBERED)
        self.whole_words = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)

    def words(self, text: str) -> list[str]:
        """The parts of a text that can be encoded for themselves, spaces in front."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        if not self.whole_words:
            return [text]
        if SPACE + SPACE in text:
            return re.findall(f"{SPACE}+[^{SPACE}]*", text)
        return [SPACE + w for w in text[1:].split(SPACE)]

    def parts(self, word: str) -> list[str]:
        """``word`` cut where no piece of the vocabulary goes on."""
        if self.neighbours.issuperset(map(add, word, word[1:])):
            return [word]
        pairs = enumerate(map(add, word, word[1:]), 1)
        cuts = [k for k, pair in pairs if pair not in self.neighbours]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def pieces(self, part: str) -> list[str]:
        # Ties among runs of spaces: the leftmost merge decides, which a pair cannot know.
        for tied in self.merges.least_tied:
            if tied in part:
                return self.merges(part)
        return self.split(part)

    def encode_part(self, part: str) -> bytes:
        """Ids as packed uint32; bytes in a dict are nothing the garbage collector visits."""
        out = array("I")
        for piece in self.pieces(part):
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            else:
                out.extend(self.byte_ids[b] for b in piece.encode())
        return out.tobytes()

    def encode_word(self, word: str) -> bytes:
        return b"".join([self.of_part[part] for part in self.parts(word)])

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text as uint32."""
        return np.frombuffer(b"".join(map(self.of_word.__getitem__, self.words(text or ""))), "I")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space in front goes, bytes that are no UTF-8 become U+FFFD."""
        kinds = self.kinds
        first = next((i for i in ids if kinds[i] != "control"), None)
        out = self._join(ids)
        if first is not None and kinds[first] == "text" and self.raw[first].startswith(b" "):
            return out[1:]
        return out

    def _join(self, ids: list[int]) -> str:
        try:
            if all(i > 2 for i in ids[:1]) and 0 not in ids:
                return b"".join(map(self.raw.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            pass
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.kinds[i] == "byte":
                run += self.raw[i]
                continue
            out.append(_lenient(bytes(run)))
            run.clear()
            if i >= 0:
                out.append(" ⁇ " if self.kinds[i] == "unknown" else self.raw[i].decode())
        return "".join(out)


def _lenient(run: bytes) -> str:
    """UTF-8, with one U+FFFD for each byte that is not part of a character."""
    out = []
    while run:
        try:
            out.append(run.decode())
            break
        except UnicodeDecodeError as bad:
            out.append(run[: bad.start].decode() + "�")
            run = run[bad.start + 1 :]
    return "".join(out)


def tokens(docs: DataFrame, vocabulary: str = MODEL, with_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row and, if asked for,
    ``ids`` and ``decoded``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        path = public_tokenizers.path(vocabulary)
        model = per_process(f"pieces {path}", lambda: PieceModel(path))
        decimal = [str(i) for i in range(len(model.names))]
        for chunk in text_chunks(batches):
            rows = []
            for text in chunk["text"]:
                ids = model.encode(text if isinstance(text, str) else "").tolist()
                decoded = model.decode(ids)
                row = (
                    len(ids),
                    hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                )
                rows.append((*row, ids, decoded) if with_ids else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", chunk["doc_id"].astype("Int64"))
            yield out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        run, schema + (", ids array<long>, decoded string" if with_ids else "")
    )
