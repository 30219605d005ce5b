"""Byte-level BPE as a lazily determinised finite-state transducer, with a streaming decoder.

Encoding. A sequence of tokens is the one that the merges give exactly when each pair of
neighbours is: the merges applied to the two tokens' bytes leave the two tokens. So a reader of
bytes holds a few *readings*: the token before, the node of a trie of tokens for the token in
progress, and the tokens not emitted yet. A byte advances each reading; one that completes a
token compatible with the one before also begins a new one. Tokens that all readings share are
emitted; what is pending never exceeds the longest token. Sets of readings are the states of the
transducer, made when first needed and kept in a bounded table. When it is full, the half made first
stays: what is frequent was met early, so the common part of a language is never made twice.

Whether two tokens may be neighbours follows from their merge trees: along the border, the last
parts of the left token and the first parts of the right one exist for a while each; the pair is
broken if two of them that exist together merge before either is used otherwise.

Decoding. Tokens pass through a UTF-8 state machine that keeps an incomplete character's bytes
from one token to the next, and replaces what can't be one. Its transitions are tabled by state
and token, when first needed.

Null text is the empty text: no ids. Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import itertools
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from fieldseason.llm.common import held, map_rows, texts

#: Bounds of the tables: parts of text of at most ``LONGEST`` characters, states, and pairs of tokens.
CACHED_WORDS, LONGEST, CACHED_STATES, CACHED_PAIRS = 300_000, 48, 160_000, 300_000

#: White space that is no space or newline, and a full stop or comma after anything but a letter or digit.
_OTHER_SPACE, _MARK_AFTER = re.compile(r"[^\S \n]"), re.compile(r"[.,](?<=[\W_].)")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: merge the pair of lowest rank, leftmost first, until no pair is a token."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == len(ranks):
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def first_half(table: dict) -> dict:
    """What was put into a table first: the frequent, as text goes."""
    return dict(itertools.islice(table.items(), len(table) // 2))


class Transducer:
    """Token ids of pieces of text under ``ranks``."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {r: t for t, r in ranks.items()}
        trie: list[dict[int, int]] = [{}]
        token_at: dict[int, int] = {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if (child := trie[node].get(byte)) is None:
                    trie.append({})
                    child = trie[node][byte] = len(trie) - 1
                node = child
            token_at[node] = rank
        # Of a node and byte: the next node, its token or -1, and whether longer tokens go on from it.
        self._trie = [{byte: (child, token_at.get(child, -1), bool(trie[child])) for byte, child in node.items()} for node in trie]
        self._borders: dict[int, list[tuple[bytes, int, int]]] = {}
        self._pairs: dict[int, bool] = {}
        self._ids: dict[tuple, int] = {}
        self._sets: list[tuple] = []
        self._arcs: dict[int, tuple[tuple, int]] = {}  # by state * 256 + byte
        self._state(((-1, 0, ()),))

    def _make_room(self) -> None:
        if len(self._sets) > CACHED_STATES:
            n = CACHED_STATES // 2
            self._sets = self._sets[:n]
            self._ids = dict(itertools.islice(self._ids.items(), n))
            self._arcs = {at: arc for at, arc in self._arcs.items() if at < n << 8 and arc[1] < n}
        if len(self._pairs) > CACHED_PAIRS:
            self._pairs = first_half(self._pairs)

    def _state(self, readings: tuple) -> int:
        if (state := self._ids.get(readings)) is None:
            state = self._ids[readings] = len(self._sets)
            self._sets.append(readings)
        return state

    def _border(self, token: int, last: bool) -> list[tuple[bytes, int, int]]:
        """The token's last (or first) parts, smallest first, each with its rank and the rank that uses it up."""
        if (found := self._borders.get(2 * token + last)) is None:
            whole, parts = self.tokens[token], []
            part, border = [whole[i:i + 1] for i in range(len(whole))], -1 if last else 0
            parts.append(part[border])
            while len(part) > 1:
                _, at = min((self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(part, part[1:], strict=False)))
                part[at:at + 2] = [part[at] + part[at + 1]]
                if part[border] != parts[-1]:
                    parts.append(part[border])
            made = [-1] + [self.ranks[p] for p in parts[1:]]
            found = self._borders[2 * token + last] = list(zip(parts, made, made[1:] + [len(self.ranks)], strict=True))
        return found

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens as they are, side by side."""
        a, b, i, j, ranks = self._border(left, True), self._border(right, False), 0, 0, self.ranks
        while i < len(a) and j < len(b):
            (x, _, x_used), (y, _, y_used) = a[i], b[j]
            rank = ranks.get(x + y)
            # Of equal ranks the leftmost pair merges first: the one inside the left token.
            if rank is not None and rank < x_used and rank <= y_used:
                return False
            if x_used <= y_used:
                i += 1
            else:
                j += 1
        return True

    def _arc(self, state: int, byte: int) -> tuple[tuple, int]:
        readings, trie, pairs, shared = [], self._trie, self._pairs, None
        for before, node, pending in self._sets[state]:
            if (step := trie[node].get(byte)) is None:
                continue
            child, token, longer = step
            if longer:
                readings.append((before, child, pending))
                if shared is None:
                    shared = pending
                elif shared:
                    shared = _both(shared, pending)
            if token >= 0:
                if before >= 0:
                    if (fits := pairs.get(before << 20 | token)) is None:
                        fits = pairs[before << 20 | token] = self.neighbours(before, token)
                    if not fits:
                        continue
                pending = (*pending, token)
                readings.append((token, 0, pending))
                if shared is None:
                    shared = pending
                elif shared:
                    shared = _both(shared, pending)
        if shared:
            n = len(shared)
            readings = [(b, c, p[n:]) for b, c, p in readings]
        arc = self._arcs[state << 8 | byte] = (shared, self._state(tuple(readings)))
        return arc

    def encode(self, piece: bytes) -> list[int]:
        if len(self._sets) > CACHED_STATES or len(self._pairs) > CACHED_PAIRS:
            self._make_room()
        out, state = [], 0
        for at in range(0, len(piece), 1024):  # a piece may be very long
            if at:
                readings = self._sets[state]
                self._make_room()
                state = self._state(readings)
            known = self._arcs.get
            for byte in piece[at:at + 1024]:
                shared, state = known(state << 8 | byte) or self._arc(state, byte)
                if shared:
                    out += shared
        for _, node, pending in self._sets[state]:
            if node == 0:
                return out + list(pending)
        raise AssertionError("a byte is always a token")


def _both(a: tuple, b: tuple) -> tuple:
    """What two sequences begin with alike."""
    if not a or not b or a[0] != b[0]:
        return ()
    n = 1
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a if n == len(a) else a[:n]


class Utf8Stream:
    """Text of tokens as they come; ``finish`` gives what an unfinished last character leaves.

    A state is the bytes of a character begun: none for most tokens. The step from a state by a
    token is worked out once and then looked up.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self._tokens = tokens
        self._steps: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}

    def _step(self, held: bytes, token: int) -> tuple[str, bytes]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        text = machine.decode(held + self._tokens[token])
        step = text, machine.getstate()[0]
        self._steps.setdefault(step[1], {})
        self._steps[held][token] = step
        return step

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        held, steps = b"", self._steps[b""]
        for token in ids:
            text, after = steps.get(token) or self._step(held, token)
            if after != held:
                held, steps = after, self._steps[after]
            yield text
        yield held.decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """What ``make`` gives for a part of text, in two bounded tables.

    A part goes to this one when it is met again; of a text's many parts most never are, and wait in
    the other one, which forgets the half it has had longest. This one, when full, forgets the newest.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__({"": b""})
        self._make, self._once = make, {}

    def __missing__(self, part: str) -> bytes:
        if (ids := self._once.pop(part, None)) is not None:
            if len(self) >= CACHED_WORDS * 2 // 3:
                for _ in range(len(self) // 4):
                    self.popitem()
            self[part] = ids
            return ids
        ids = self._make(part)
        if len(part) <= LONGEST:
            if len(self) + len(self._once) >= CACHED_WORDS:
                self._once = dict(itertools.islice(self._once.items(), len(self._once) // 2, None))
            self._once[part] = ids
        return ids


def _parts(text: str) -> list[str] | None:
    """A text cut at some of the places where one piece ends and another begins; ``None`` where that needs the pattern.

    A space begins a piece if no white space follows, and a newline is one if at most a newline is
    beside it, or a space after it. So is a full stop or comma between a letter or digit and either.
    """
    if "  " in text or " \n" in text or "\n\n\n" in text or "\n\n " in text or text.endswith(("\n\n", "\n ")) or "\0" in text:
        return None
    if _OTHER_SPACE.search(text) or _MARK_AFTER.search(text):
        return None
    cut = text.replace(" ", "\0 ").replace("\n", "\0\n\0") + "\0"
    return cut.replace(",\0", "\0,\0").replace(".\0", "\0.\0").split("\0")


class Codec:
    """Encoding of whole texts part by part, with bounded tables of parts met before."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        ranks = read_ranks(path)
        self._pieces = regex.compile(public_tokenizers.PATTERN).findall
        self._transducer, self._known = Transducer(ranks), _Known(self._ids)
        self.tokens = {r: t for t, r in ranks.items()}
        # The tables hold no cycles, and millions of their tuples would be walked through again and again.
        gc.set_threshold(200_000, 20, 100)
        self.stream = Utf8Stream(self.tokens)

    def _ids(self, part: str) -> bytes:
        pieces = self._pieces(part)
        if len(pieces) > 1:
            return b"".join(map(self._known.__getitem__, pieces))
        return _packed(self._transducer.encode(part.encode("utf-8", "surrogatepass")))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._known.__getitem__, _parts(text) or self._pieces(text)))


def _codec(path: str) -> Codec:
    return held(("bpe", path), lambda: Codec(path))


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids``: the ids of each text as little-endian unsigned 32-bit integers."""

    def make() -> Callable[[dict], dict]:
        codec = _codec(path or byte_bpe_path())

        def work(rows: dict) -> dict:
            ids = [codec.encode(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids}

        return work

    return map_rows(texts(docs), make, "doc_id long, n_tokens long, ids binary")


def _decoded(codec: Codec, ids: bytes) -> str:
    return "".join(codec.stream.decode(np.frombuffer(ids, "<u4").tolist()))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``."""

    def make() -> Callable[[dict], dict]:
        codec = _codec(path or byte_bpe_path())
        return lambda rows: {"doc_id": rows["doc_id"], "text": [_decoded(codec, x) for x in rows["ids"]]}

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, text string")


def round_trip(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``encode``'s rows, whose ids are decoded again."""

    def make() -> Callable[[dict], dict]:
        codec = _codec(path or byte_bpe_path())
        digest = lambda x: hashlib.sha256(x).hexdigest()
        return lambda rows: {
            "doc_id": rows["doc_id"], "n_tokens": rows["n_tokens"], "ids_sha256": [digest(x) for x in rows["ids"]],
            "decoded_sha256": [digest(_decoded(codec, x).encode()) for x in rows["ids"]]}

    return map_rows(encoded, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
