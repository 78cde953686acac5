"""SentencePiece encoding and decoding for merge-type (BPE) models with byte fallback, exactly.

A text is cut where no token can lie: before a white-space mark that follows another character, and around
characters that the vocabulary lacks (they become byte tokens). In each part an Aho-Corasick automaton finds the
longest matches; the encoder takes the longest match, checks that it is compatible with the token before (merging both
tokens' characters anew gives the same two tokens), and backtracks to shorter matches otherwise. Whether two tokens are
compatible is told by undoing their merges along the border, latest first: they are unless a merge across comes earlier.
A mark per position tells dead ends, so no position is tried twice and the work is linear.

The ids of parts are remembered in a bounded table per worker. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tabguard.llm.common import keyed

MARK = "▁"
#: Entries of a worker's tables; of parts there are two, of which the older is forgotten.
PARTS_KEPT = 200_000
PAIRS_KEPT = 250_000
#: Parts longer than this are not remembered.
_LONG_PART = 64


class Pieces:
    """Encoder and decoder over the vocabulary of a merge-type model with byte fallback."""

    def __init__(self, model_path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.end_id = model.eos_id()
        self.unknown_id = model.unk_id()
        self.texts = [model.id_to_piece(i) for i in range(n)]
        self.control = [model.is_control(i) for i in range(n)]
        self.byte = {i: int(self.texts[i][1:-1], 16) for i in range(n) if model.is_byte(i)}
        self.byte_ids = {v: i for i, v in self.byte.items()}
        plain = [i for i in range(n) if i not in self.byte and not self.control[i] and i != self.unknown_id and not model.is_unused(i)]
        self.plain = set(plain)
        self.ids = {self.texts[i]: i for i in plain}
        self.rank = {self.texts[i]: -model.get_score(i) for i in plain}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.parts: dict[str, str] = {}
        self.aged: dict[str, str] = {}
        self.lengths = [len(t) for t in self.texts]
        self.names = [str(i) for i in range(n)]
        # A token that its own characters do not merge to can never be produced.
        self.made = []
        halves: dict[str, tuple[str, str]] = {}  # of a token, those that its last merge joins
        for t in self.ids:
            if len(t) > 1:
                parts, last = self._merged(t)
                if parts != [t]:
                    continue
                halves[t] = last
            self.made.append(t)
        self.chars = {t for t in self.made if len(t) == 1}
        # by id: the rank of the merge that makes a token and its halves; characters are there from the start
        self.order = [-math.inf] * n
        self.halves: list[tuple[int, int] | None] = [None] * n
        often = Counter(self.rank[t] for t in halves)
        uneven: set[str] = set()  # tokens with merges of equal rank, or of a better rank than one before
        for t in sorted(halves, key=len):
            self.order[self.ids[t]], self.halves[self.ids[t]] = self.rank[t], (self.ids[halves[t][0]], self.ids[halves[t][1]])
            if often[self.rank[t]] > 1 or any(h in uneven or h in halves and self.rank[h] >= self.rank[t] for h in halves[t]):
                uneven.add(t)
        self.uneven = {self.ids[t] for t in uneven}
        automaton = ahocorasick.Automaton()
        for t in self.made:
            automaton.add_word(t, (len(t) - 1, self.ids[t]))
        automaton.make_automaton()
        self.automaton = automaton
        made = set(self.made)
        # the next shorter token that begins a token
        self.shorter = {
            self.ids[t]: next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in made), None) for t in self.made
        }
        # line ends and tabs lie in no token of most vocabularies, and then end a part, too
        apart = "".join(c for c in "\n\r\t" if c not in self.chars and not any(c in t for t in self.ids))
        self.cut = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|[{apart}]+" if apart else ""))

    def merged(self, text: str) -> list[str]:
        """The merges carried out one by one: the best-ranked adjacent pair first, the leftmost of equal ones."""
        return self._merged(text)[0]

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """What is left after all merges, and the last one."""
        last = None
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                joined = parts[i] + parts[j]
                rank = self.rank.get(joined)
                if rank is not None:
                    heapq.heappush(queue, (rank, i, j, joined))

        for i in range(len(parts)):
            offer(i)
        while queue:
            _, i, j, joined = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != joined:
                continue
            last = parts[i], parts[j]
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None], last

    def apart(self, left: int, right: int) -> bool:
        """Whether the two tokens, merged anew from their characters, come out as they are.

        The merges that made them are undone along the border, the latest first; before each, no pair across the border
        may have been worth merging earlier. Of merges of equal rank the one farther left is the earlier.
        """
        if left in self.uneven or right in self.uneven:
            a, b = self.texts[left], self.texts[right]
            return self.merged(a + b) == [a, b]
        texts, rank, order, halves = self.texts, self.rank, self.order, self.halves
        limit, of_left = math.inf, True
        while True:
            across = rank.get(texts[left] + texts[right])
            if across is not None and (across < limit or across == limit and not of_left):
                return False
            if order[left] > order[right]:
                limit, of_left, left = order[left], True, halves[left][1]
            elif halves[right] is not None:
                limit, of_left, right = order[right], False, halves[right][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        """What ``apart`` tells, remembered."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.apart(left, right)
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def backtrack(self, text: str) -> list[int]:
        """Token ids of a text of known characters."""
        size = len(text)
        longest: list[int | None] = [None] * size
        matches = self.automaton.iter_long
        for end, (before, token) in matches(text):  # the longest from the start, then from its end, and so on
            longest[end - before] = token
        lengths, pairs = self.lengths, self.pairs
        out: list[int] = []
        failed = bytearray(size + 1)  # whether no compatible tokens lead on from a position
        at, token = 0, longest[0]
        while token is not None:
            end = at + lengths[token]
            if not failed[end]:
                if out:
                    fits = pairs.get((out[-1], token))
                    if fits is None:
                        fits = self.compatible(out[-1], token)
                else:
                    fits = True
                if fits:
                    out.append(token)
                    at = end
                    if at == size:
                        return out
                    token = longest[at]
                    if token is None:  # a position that the longest matches so far pass over
                        for end, (before, token) in matches(text, at):
                            if longest[end - before] is not None:
                                break
                            longest[end - before] = token
                        token = longest[at]
                    continue
            token = self.shorter[token]
            while token is None:
                failed[at] = 1
                if not out:
                    raise ValueError("the vocabulary lacks a character")
                last = out.pop()
                at -= lengths[last]
                token = self.shorter[last]
        raise ValueError("the vocabulary lacks a character")

    def encode_part(self, part: str) -> list[int]:
        """Ids of one part; characters outside the vocabulary become the tokens of their bytes."""
        if self.chars.issuperset(part):
            return self.backtrack(part)
        ids: list[int] = []
        known: list[str] = []
        for c in part:
            if c in self.chars:
                known.append(c)
                continue
            if known:
                ids += self.backtrack("".join(known))
                known = []
            ids += [self.byte_ids[b] for b in c.encode("utf-8", "replace")]
        return ids + (self.backtrack("".join(known)) if known else [])

    def part(self, part: str) -> tuple[int, str, str]:
        """Number of ids, ids as text, and the text that they decode to, of one part.

        Ids that decode to the part itself with blanks for marks are remembered, which all but odd ones do.
        """
        found = self.parts.get(part) or self.aged.pop(part, None)
        if found is None:
            ids = self.encode_part(part)
            found, surface = " ".join([self.names[i] for i in ids]), self.surface(ids)
            if surface != part.replace(MARK, " "):
                return len(ids), found, surface
        else:
            surface = part.replace(MARK, " ")
        if len(part) <= _LONG_PART:
            if len(self.parts) >= PARTS_KEPT and part not in self.parts:  # those not asked for since the last change of tables are forgotten
                self.aged, self.parts = self.parts, {}
            self.parts[part] = found
        return found.count(" ") + 1, found, surface

    def cut_parts(self, text: str | None) -> list[str]:
        """The parts of a text with its leading mark; none for an empty text."""
        return self.cut.findall((MARK + text).replace(" ", MARK)) if text else []

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text with the end id."""
        return [i for p in self.cut_parts(text) for i in self.encode_part(p)] + [self.end_id]

    def surface(self, ids: Sequence[int]) -> str:
        """The pieces of the ids as text, white-space marks as blanks; bytes that are no UTF-8 become U+FFFD each."""
        if self.plain.issuperset(ids):
            return "".join([self.texts[i] for i in ids]).replace(MARK, " ")
        out: list[str] = []
        held = bytearray()
        for i in [*ids, None]:
            if i in self.byte:
                held.append(self.byte[i])
                continue
            if held:
                out.append(_decoded(bytes(held)))
                held.clear()
            if i is None or self.control[i]:
                continue
            out.append(" ⁇ " if i == self.unknown_id else self.texts[i].replace(MARK, " "))
        return "".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids, without the blank that encoding puts in front."""
        start = next((i for i, t in enumerate(ids) if not self.control[t]), None)
        if start is None:
            return ""
        text = self.surface(ids[start:])
        return text[1:] if self.texts[ids[start]].startswith(MARK) else text


def _decoded(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_LOADED: dict[str, Pieces] = {}


def pieces(model_path: str) -> Pieces:
    """The model at that path, loaded once per process."""
    if model_path not in _LOADED:
        _LOADED[model_path] = Pieces(model_path)
    return _LOADED[model_path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ids, the token ids of the whole text with the end id (only that for null and empty texts).

    The model file must lie at ``model_path`` on every machine. Repeated ids and rows each give a row, null ids stay
    null, other columns are ignored, an empty input gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model_path)
        for batch in batches:
            ids = [known.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    source = keyed(docs, doc_id=id_col, text=text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id and text, decoded from the token ids; null ids give null, ids outside the vocabulary fail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model_path)
        for batch in batches:
            texts = [None if not x.is_valid else known.decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = keyed(encoded, doc_id=id_col, ids=ids_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")


def token_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each row in one pass; digests only: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Works part by part on the same tables as ``encode_documents`` and ``decode_documents`` and equals their results:
    decoding the ids of a text is decoding those of its parts one after the other, without the first blank.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model_path)
        one, end = known.part, str(known.end_id)
        for batch in batches:
            counts, ids, texts = [], [], []
            for text in batch.column(1):
                parts = known.cut_parts(text.as_py())
                found = list(map(known.parts.get, parts))
                odd: dict[int, str] = {}  # by place, decoded parts that are not simply the part
                if None in found:
                    for i, part in enumerate(parts):
                        if found[i] is None:
                            _, found[i], surface = one(part)
                            if surface != part.replace(MARK, " "):
                                odd[i] = surface
                found.append(end)
                numbers = " ".join(found)
                if odd:
                    decoded = "".join([odd.get(i, p.replace(MARK, " ")) for i, p in enumerate(parts)])
                else:
                    decoded = "".join(parts).replace(MARK, " ")
                counts.append(numbers.count(" ") + 1)
                ids.append(hashlib.sha256(numbers.encode()).hexdigest())
                texts.append(hashlib.sha256(decoded[1:].encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        known.aged = {}  # workers outlive a task and may serve other stages next
        pa.default_memory_pool().release_unused()

    source = keyed(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
