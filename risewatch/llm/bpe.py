"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

Encoding. Text streams through in pieces cut at white space, which no token crosses. A pre-token (word) of any length is
read into a window; its merges are applied, and the tokens that end `lookahead` bytes or more before the window's end are
stable: whatever follows cannot change them, so they are emitted and the window moves on. `lookahead` follows from the
merge list: a decision at the right edge can only reach further left through chains of merges of rising rank, each of which
shares a symbol with the one before, and the longest such chain, in bytes, is the bound. It holds if every merge uses
symbols that are bytes or products of earlier merges, each made by one merge; other lists are refused.

Decoding. Ids become bytes, bytes become text in an incremental UTF-8 state machine that keeps at most three bytes between
calls and puts U+FFFD for what is no UTF-8. A vocabulary file without a decoder is decoded by its library to the token
strings with a space between; that form is there too, as `token_text`.

Defined cases: null is the empty text with no tokens; special tokens in a text become their ids; repeated rows give equal
results; other columns play no part.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risewatch.llm.shared import map_batches

PIECE = 1 << 18
CACHED_WORDS, CACHED_LENGTH = 250_000, 48


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Coder:
    """A byte-level BPE vocabulary file (JSON of the tokenizers library) with word ends, NFC and lower case."""

    def __init__(self, path: str) -> None:
        spec = json.loads(Path(path).read_text())
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in pre] != ["Split", "ByteLevel"] or model["continuing_subword_prefix"]:
            raise ValueError(f"{path} is not a word-end byte-level BPE vocabulary")
        if spec.get("decoder") is not None:
            raise ValueError(f"{path} names a decoder; only files without one are decoded as the library does")
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for text, i in [*self.vocab.items(), *self.special.items()]:
            self.names[i] = text
        self.name_bytes = [x.encode() for x in self.names]
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.bytes = [b""] * len(self.names)
        for text, i in self.vocab.items():
            body, last = (text[: -len(self.end)], b" ") if self.end and text.endswith(self.end) else (text, b"")
            self.bytes[i] = bytes(byte_of[c] for c in body) + last
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.inner = [self.vocab[c] for c in alphabet]
        self.last = [self.vocab[c + self.end] for c in alphabet]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.rank = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.product = [product for _, product in self.merges.values()]
        self.lookahead = self._lookahead()
        self.window = 4 * self.lookahead
        # \s of the file's pattern is the White_Space property; texts in ASCII, already lowered, take the plainer form
        pattern = pre[0]["pattern"]["Regex"]
        self.any_words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.ascii_words = re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.decimal = [str(i) for i in range(len(self.names))]
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def _lookahead(self) -> int:
        """Bytes that decide on a token behind its end: the longest chain of merges of rising rank that hands an influence on.

        far[s]: how far left a doubt about symbol s can reach through merges of higher rank. A doubtful merge puts its left
        symbol and its product in doubt; a doubtful symbol puts a merge that has it on the right in doubt, one symbol
        further left, or one that has it on the left, at the same place.
        """
        length = [len(x) for x in self.bytes]
        far = [0] * len(self.names)
        made, used = {}, {}
        for (a, b), (rank, product) in self.merges.items():
            if product in made:
                raise ValueError("two merges make the same symbol")
            made[product] = rank
            for x in (a, b):
                used[x] = min(used.get(x, rank), rank)
        if any(rank >= used.get(x, rank + 1) for x, rank in made.items()):
            raise ValueError("a merge uses a symbol that is made later")
        longest = max(length)
        for (a, b), (_, product) in sorted(self.merges.items(), key=lambda x: -x[1][0]):
            on = max(far[a], far[product])
            far[b] = max(far[b], length[a] + on)
            far[a] = max(far[a], on)
            longest = max(longest, length[a] + on)
        return longest

    def _merged(self, ids: list[int]) -> list[int]:
        """All merges applied, lowest rank first, leftmost first."""
        if len(ids) < 32:
            rank, never, product = self.rank.get, 1 << 30, self.product
            ranks = list(map(rank, zip(ids, ids[1:], strict=False), repeat(never)))
            while ranks and (best := min(ranks)) < never:
                i = ranks.index(best)
                ids[i : i + 2] = [product[best]]
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = rank((ids[i], ids[i + 1]), never)
                if i:
                    ranks[i - 1] = rank((ids[i - 1], ids[i]), never)
            return ids
        merges = self.merges
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(*merges[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in merges]
        heap = [(rank, i, a, b, new) for rank, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (found := merges.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (found[0], x, ids[x], ids[y], found[1]))
        return [x for x in ids if x >= 0]

    def word_ids(self, chunks: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of one pre-token that arrives in chunks of bytes; holds a window, not the word."""
        held = b""
        for chunk in chunks:
            held += chunk
            while len(held) > self.window:
                part, held = held[: self.window], held[self.window :]
                out, at, stable = self._merged([self.inner[x] for x in part]), 0, []
                for token in out:
                    at += len(self.bytes[token])
                    if at > len(part) - self.lookahead:
                        break
                    stable.append(token)
                held = part[sum(len(self.bytes[x]) for x in stable) :] + held
                yield stable
        if held:
            yield self._merged([*(self.inner[x] for x in held[:-1]), self.last[held[-1]]])

    def _new(self, word: str) -> tuple[int, ...]:
        ids = self.old.get(word)
        if ids is None:
            data = word.encode("utf-8", "surrogatepass")
            step = self.window
            if len(data) <= step:
                symbols = list(map(self.inner.__getitem__, data))
                symbols[-1] = self.last[data[-1]]
                ids = tuple(self._merged(symbols))
            else:
                ids = tuple(chain.from_iterable(self.word_ids(data[i : i + step] for i in range(0, len(data), step))))
        if len(word) <= CACHED_LENGTH:
            if len(self.young) >= CACHED_WORDS:
                self.old, self.young = self.young, {}
            self.young[word] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # sigma has no final form when characters are lowered one by one
        text = text.replace("Σ", "σ").lower()
        words = self.ascii_words(text) if text.isascii() else self.any_words(text)
        found = list(map(self.young.get, words))
        if None in found:
            found = [self._new(w) if x is None else x for w, x in zip(words, found, strict=True)]
        return list(chain.from_iterable(found))

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Ids of the text, piece by piece; pieces end before white space."""
        text, at = text or "", 0
        space = regex.compile("[ \n\t\r]")
        while at < len(text):
            cut = len(text) if len(text) - at <= PIECE else (m.start() if (m := space.search(text, at + PIECE)) else len(text))
            piece, at = text[at:cut], cut
            if self.split and "<" in piece:
                for part in self.split(piece):
                    yield [self.special[part]] if part in self.special else self._plain(part)
            else:
                yield self._plain(piece)

    def token_text(self, pieces: Iterable[list[int]]) -> Iterator[str]:
        """The library's form, as the file has no decoder: token strings with a space between."""
        machine, ids_before = ByteText(self.name_bytes, b" "), False
        for ids in pieces:
            if ids:
                yield (" " if ids_before else "") + machine.feed(ids)
                ids_before = True
        yield machine.end()

    def decode(self, pieces: Iterable[list[int]]) -> Iterator[str]:
        """The text of the ids, a space after every word."""
        machine = ByteText(self.bytes)
        for ids in pieces:
            yield machine.feed(ids)
        yield machine.end()


class ByteText:
    """Incremental byte-to-text state machine: gives out text as soon as its characters are whole.

    Its state is the at most three bytes of an unfinished character; bytes that make none become U+FFFD.
    """

    def __init__(self, table: list[bytes], gap: bytes = b"") -> None:
        self.bytes_of, self.gap = table.__getitem__, gap
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.machine.decode(self.gap.join(map(self.bytes_of, ids)))

    def end(self) -> str:
        return self.machine.decode(b"", final=True)


@lru_cache(maxsize=4)
def coder(path: str) -> Coder:
    return Coder(path)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int> of every document."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = coder(path)
        ids = [list(chain.from_iterable(code.encode(x))) for x in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), each, "doc_id long, ids array<int>")


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, restored_sha256 of every document.

    The ids are decoded as they stream, by the state machine, to the library's form (token strings, as the file has no
    decoder) and to the text that they stand for (a space after every word); all three are hashed piece by piece.
    """
    digests = ["ids_sha256", "decoded_sha256", "restored_sha256"]

    def digest(code: Coder, text: str | None) -> tuple[int, str, str, str]:
        n, hashes = 0, [hashlib.sha256() for _ in digests]
        named, restored = ByteText(code.name_bytes, b" "), ByteText(code.bytes)
        for ids in code.encode(text):
            if ids:
                gap = " " if n else ""
                hashes[0].update((gap + " ".join(map(code.decimal.__getitem__, ids))).encode())
                hashes[1].update((gap + named.feed(ids)).encode())
                hashes[2].update(restored.feed(ids).encode())
                n += len(ids)
        hashes[1].update(named.end().encode())
        hashes[2].update(restored.end().encode())
        return n, *(x.hexdigest() for x in hashes)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = coder(path)
        found = [digest(code, x) for x in batch.column(1).to_pylist()]
        columns = [pa.array([x[0] for x in found], pa.int64())] + [pa.array([x[k] for x in found], pa.string()) for k in (1, 2, 3)]
        return pa.record_batch([batch.column(0), *columns], names=["doc_id", "n_tokens", *digests])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(texts, each, "doc_id long, n_tokens long, " + ", ".join(f"{x} string" for x in digests))
