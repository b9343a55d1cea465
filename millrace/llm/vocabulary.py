"""Public tokenizer vocabularies, applied word by word with a bounded memory of results.

Both vocabularies here never join characters across the start of a word, so a text can be
cut there and each different word is worked out once per task.
"""

from __future__ import annotations

import base64
import re
import sys
import types
from collections.abc import Callable
from heapq import heapify, heappop, heappush
from operator import add

MEMO_WORDS = 1_000_000


def path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in ``folder``, else where the installed package keeps it."""
    if folder is not None:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_memory(key: tuple, make: Callable):
    """An object that a Python worker makes once and keeps for its later tasks."""
    kept = sys.modules.setdefault("millrace_worker_memory", types.ModuleType("millrace_worker_memory")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def forget_memory() -> None:
    """Let go of what the earlier tasks of this Python worker kept, which may be much, for a step that needs the room."""
    sys.modules.pop("millrace_worker_memory", None)


class Memo(dict):
    """Results by key; beyond ``limit`` keys new ones are worked out each time."""

    def __init__(self, work: Callable, limit: int = MEMO_WORDS) -> None:
        super().__init__()
        self.work, self.limit = work, limit

    def __missing__(self, key):
        value = self.work(key)
        if len(self) < self.limit:
            self[key] = value
        return value


class PieceCounter:
    """Token counts of a piece vocabulary with byte fallback, by merging adjacent symbols.

    The symbols of a word form a linked list; a heap holds the adjacent pairs that are
    pieces. The best pair (lowest rank, then leftmost) is popped and joined until the heap
    is empty. Stale heap entries are known by their length. The count is the number of
    initial symbols less the merges, where a symbol without a piece stands for its bytes.
    """

    MARK = "▁"

    def __init__(self, model_file: str, limit: int = MEMO_WORDS) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        scores = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        order = {score: k for k, score in enumerate(sorted(set(scores.values())))}
        self.rank = {piece: order[score] for piece, score in scores.items()}
        self.known = frozenset(piece for piece in self.rank if len(piece) == 1)
        inner = re.compile(f"[^{self.MARK}]{self.MARK}")
        if any(inner.search(piece) or "\n" in piece[:-1] or piece.endswith("\n") for piece in self.rank):
            raise ValueError("pieces of this vocabulary cross word starts or lines")
        self.memo = Memo(self._part, limit)
        self.cut = re.compile(f"{self.MARK}+[^{self.MARK}\n]*|[^{self.MARK}\n]+|\n")

    def _part(self, part: str) -> int:
        """A word after a space, or a line feed with the word that follows it."""
        if part[:1] == "\n":
            return self._newline() + (self.merged(part[1:]) if len(part) > 1 else 0)
        return self.merged(self.MARK + part)

    def _newline(self) -> int:
        return 1

    def count(self, text: str) -> int:
        """Tokens of a text; a mark is put before its first word, as the library does."""
        if not text:
            return 0
        spaced = text.replace("\n", " \n")
        if spaced[0] != " " and spaced[-1] != " " and "  " not in spaced and self.MARK not in text:
            return sum(map(self.memo.__getitem__, spaced.split(" ")))
        marked = self.MARK + text.replace(" ", self.MARK)
        return sum(self._newline() if run == "\n" else self.merged(run) for run in self.cut.findall(marked))

    def merged(self, symbols: str) -> int:
        """Tokens of a run of symbols.

        ``size[i]`` leads from the symbol that starts at ``i`` to the next one and
        ``back[i]`` to the one before; 0 marks a place that is no start any more. A heap
        entry holds rank, start and length of a pair, in this order.
        """
        rank, n = self.rank, len(symbols)
        if n == 1:
            return self._single(symbols)
        bits = n.bit_length()
        mask = (1 << bits) - 1
        heap = []
        at = 2
        for pair in map(add, symbols, symbols[1:]):
            found = rank.get(pair)
            if found is not None:
                heap.append(found << 2 * bits | at - 2 << bits | 2)
            at += 1
        heapify(heap)
        size = [1] * n
        back = list(range(-1, n - 1))
        merges = 0
        while heap:
            entry = heappop(heap)
            left = entry >> bits & mask
            length = entry & mask
            own = size[left]
            right = left + own
            if not own or right >= n or own + size[right] != length:
                continue
            size[left] = length
            size[right] = 0
            merges += 1
            end = left + length
            if end < n:
                back[end] = left
                longer = length + size[end]
                found = rank.get(symbols[left : left + longer])
                if found is not None:
                    heappush(heap, found << 2 * bits | left << bits | longer)
            if left:
                start = back[left]
                found = rank.get(symbols[start:end])
                if found is not None:
                    heappush(heap, found << 2 * bits | start << bits | end - start)
        tokens = n - merges
        if tokens > 1 and not self.known.issuperset(symbols):
            tokens += sum(self._single(c) - 1 for c, s in zip(symbols, size, strict=True) if s == 1)
        return tokens

    def _single(self, symbol: str) -> int:
        return 1 if symbol in self.rank else len(symbol.encode("utf-8", "surrogatepass"))


class PieceIds:
    """Token ids of a piece vocabulary as little-endian 16-bit numbers, by its library."""

    def __init__(self, model_file: str, limit: int = 300_000) -> None:
        import numpy as np
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model_file)
        size = self.model.get_piece_size()
        if size > 1 << 16:
            raise ValueError("the ids of this vocabulary need more than 16 bits")
        self.is_byte = np.fromiter((self.model.is_byte(i) for i in range(size)), bool, size)
        self.memo = Memo(self._part, limit)

    def _pack(self, ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(2, "little") for i in ids)

    def _part(self, part: str) -> bytes:
        ids = self.model.encode(part, num_threads=1)
        return self._pack(ids[1:] if part[:1] == "\n" else ids)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        spaced = text.replace("\n", " \n")
        if spaced[0] != " " and spaced[-1] != " " and "  " not in spaced and PieceCounter.MARK not in text:
            return b"".join(map(self.memo.__getitem__, spaced.split(" ")))
        return self._pack(self.model.encode(text, num_threads=1))


class ByteIds:
    """Token ids of the byte-level vocabulary as little-endian 32-bit numbers.

    The rank file is used, as it gives the same ids as the JSON file's own library; a text
    with an added token's string in it goes to that library.
    """

    ADDED = "<|endoftext|>"

    def __init__(self, folder: str | None = None, limit: int = 300_000) -> None:
        import public_tokenizers
        import tiktoken

        with open(path("byte_bpe_50k.tiktoken", folder), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.folder = folder
        self.odd_space = re.compile(r"[^\S \n]|[ \n][ \n]")
        self.encode = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.memo = Memo(self._part, limit)
        self.library = None

    def _pack(self, ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _part(self, part: str) -> bytes:
        return self._pack(self.encode(part if part[0] == "\n" else " " + part))

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.ADDED in text:
            return self._pack(self._library().encode(text, add_special_tokens=False).ids)
        if text[0] in " \n" or text[-1] in " \n" or self.odd_space.search(text):
            return self._pack(self.encode(text))
        parts = text.replace("\n", " \n").split(" ")
        first = self._pack(self.encode(parts[0]))
        return first + b"".join(map(self.memo.__getitem__, parts[1:]))

    def _library(self):
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path("byte_bpe_50k.json", self.folder))
        return self.library
