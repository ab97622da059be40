"""Byte-level BPE by a tokenization automaton: compile merges, encode by its transitions, decode by its labels."""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from scholia.llm.common import id_and_text, query, table, tidied

# How byte-level tokenizers cut a text before the merges; white space as Unicode lists it.
SPACE = r"\t-\r " + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


ROWS = 1024  # texts that a task works on at a time


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """The deterministic automaton whose paths are exactly the tokenizations that the merges produce.

    It starts as one state that loops on every byte. The gadget of a merge ``u v -> w``, in the order of
    the merges, turns the path ``u`` then ``v`` into an arc ``w``: the state after ``u`` is copied without
    its arc ``v``, arcs ``u`` lead to the copy from then on, and ``w`` leads where ``v`` leads. An arc
    ``w`` leaves every state that has an arc ``u`` by then, or gets one later.

    So a state is named by a label and a step: where that label leads after that many gadgets. The table
    ``cut`` has the step at which a state lost an arc, ``made`` the step at which an arc came into being;
    what leaves a state follows from them, and is remembered a pair at a time.
    """

    KEEP = 300_000  # pairs of labels remembered a task

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        n = max(vocab.values(), default=-1) + 1
        self.labels: list[bytes] = [b""] * n
        for label, token in vocab.items():
            self.labels[token] = label
        self.vocab = vocab
        self.first, self.second = [-1] * n, [-1] * n  # the halves of a merged label; none for a byte
        self.made = [0] * n
        self.cut: dict[int, int] = {}
        for step, (u, v) in enumerate(merges, 1):
            a, b, w = vocab[u], vocab[v], vocab[u + v]
            if self.made[w]:
                raise ValueError(f"two merges make {u + v!r}")
            self.first[w], self.second[w], self.made[w] = a, b, step
            self.cut[a << 20 | b] = step
        self.last = len(merges)
        self.arcs: dict[int, bool] = {}
        # The labels that begin whatever labels begin with, the longest first; none where only longer labels follow.
        begins = {label[:i] for label in vocab for i in range(1, len(label) + 1)}
        self.begun: dict[bytes, tuple[int, ...]] = {}
        for label in sorted(begins, key=len):
            shorter = self.begun.get(label[:-1], ())
            self.begun[label] = (vocab[label], *shorter) if label in vocab else shorter
        self.size = list(map(len, self.labels))

    def has_arc(self, after: int, label: int) -> bool:
        """Whether ``label`` may follow the label ``after`` (-1: stand first)."""
        if after < 0:
            return True  # the first state never loses an arc
        key = after << 20 | label
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= self.KEEP:
                self.arcs.clear()
            known = self.arcs[key] = self._derive(after, label)
        return known

    def _derive(self, u: int, t: int) -> bool:
        made, cut, step = self.made, self.cut, self.last
        while True:
            if cut.get(u << 20 | t, step + 1) <= step:
                return False
            if made[t] > made[u] or made[t] > step:  # as the first half could leave when t was made
                step = min(step, made[t])
                t = self.first[t]
            elif made[u]:  # t is older than u: as t can leave where u's second half led
                step = made[u] - 1
                u = self.second[u]
            else:
                return True

    def encode(self, word: bytes) -> list[int]:
        """The labels of the one path that spells ``word``.

        Any part of the word from its start has one path too, so a position has one state at most, however it is
        reached, and a position that the path doesn't pass is left once. Long arcs are tried first.
        """
        whole = self.vocab.get(word)
        if whole is not None:
            return [whole]
        n, arcs, size, begun = len(word), self.arcs.get, self.size, self.begun.get
        at, here, path, open_, left = 0, -1, [], [], set()
        while at < n:
            # labels that begin here; what begins labels has all its own beginnings, and three bytes nearly always begin one
            j = at + 3
            options = begun(word[at:j])
            if options is None:
                options = begun(word[at : at + 2]) or begun(word[at : at + 1], ())
            else:
                while j < n and (more := begun(word[at : j + 1])) is not None:
                    options, j = more, j + 1
            options = iter(options)
            while True:
                for token in options:
                    if at + size[token] in left:
                        continue
                    known = True if here < 0 else arcs(here << 20 | token)
                    if known or known is None and self.has_arc(here, token):
                        break
                else:
                    if not path:
                        raise ValueError(f"the vocabulary doesn't cover {word!r}")
                    left.add(at)
                    at -= size[path.pop()]
                    here, options = path[-1] if path else -1, open_.pop()
                    continue
                path.append(token)
                open_.append(options)
                at, here = at + size[token], token
                break
        return path


class Tokenizer:
    """Cuts a text at the added tokens and into pieces, and runs the automaton over each piece once."""

    KEEP_CHARS = 4_000_000  # characters of the pieces that a task remembers; beyond it the older ones are forgotten and met anew

    def __init__(self, spec: dict):
        byte_of = byte_symbols()
        raw = lambda s: bytes(byte_of[c] for c in s)
        model = spec["model"]
        vocab = {raw(k): v for k, v in model["vocab"].items() if all(c in byte_of for c in k)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.automaton = Automaton(vocab, [(raw(a), raw(b)) for a, b in pairs])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.labels = dict(enumerate(self.automaton.labels)) | {i: c.encode() for c, i in self.added.items()}
        special = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.pieces = regex.compile(PIECES).findall
        self.known = _Pieces(self)

    def parts(self, text: str) -> list[tuple[int, bytes, bytes]]:
        """``n_ids, ids, label bytes`` of the pieces and added tokens of a text; ids in decimals with commas between."""
        out: list[tuple[int, bytes, bytes]] = []
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                out.append((1, b"%d" % self.added[part], self.labels[self.added[part]]))
            else:
                out.extend(map(self.known.__getitem__, self.pieces(part)))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) for i in ids.split(b",")]

    def forget(self) -> None:
        """Drops what was remembered of texts; called at the end of a task, since workers are used again."""
        self.known.forget()
        self.automaton.arcs.clear()

    def decode(self, ids: list[int]) -> str:
        """The arc labels in order, as UTF-8; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


class _Pieces(dict):
    """A piece with its ids and the labels of their arcs, worked out when it is first met.

    When half of what may be remembered has been met, it grows old; once as much has been met again, what
    wasn't asked for meanwhile is forgotten, so frequent pieces stay."""

    def __init__(self, tok: Tokenizer):
        super().__init__()
        self.tok, self.held, self.older = tok, 0, {}
        self.names = [b"%d" % i for i in range(len(tok.automaton.labels))]

    def __missing__(self, s: str) -> tuple[int, bytes, bytes]:
        if 2 * self.held > self.tok.KEEP_CHARS:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += len(s)
        value = self.older.pop(s, None)
        if value is None:
            ids = self.tok.automaton.encode(s.encode())
            value = len(ids), b",".join(map(self.names.__getitem__, ids)), b"".join(map(self.tok.automaton.labels.__getitem__, ids))
        self[s] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.held, self.older = 0, {}


_LOADED: dict[str, Tokenizer] = {}


def load(spec: str) -> Tokenizer:
    """The tokenizer of a specification (the JSON text), compiled once a worker."""
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(json.loads(spec))
    return _LOADED[key]


def over_batches(spec, per_text: Callable, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, often = None, gc.get_threshold()
        gc.set_threshold(500_000, 20, 20)  # what is remembered has no cycles to be looked for
        try:
            for whole in batches:
                tok = tok or load(spec.value)
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    rows = [per_text(tok, text.as_py()) for text in batch["text"]]
                    columns = [batch["doc_id"], *([r[i] for r in rows] for i in range(len(schema) - 1))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) if isinstance(c, list) else c.cast(t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)
        finally:
            if tok:
                tok.forget()
            gc.set_threshold(*often)

    return run


def broadcast_spec(docs: DataFrame, path: str):
    """The vocabulary file as text, to every executor; its size is fixed by the tokenizer."""
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of each whole text.

    ``path`` names a byte-level BPE file of the tokenizers library (no normalizer, no prefix space).
    Added tokens in a text become their id. A null text is empty and has no ids; ids may be null or
    repeat; an empty table gives no rows; other columns aren't read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    run = over_batches(broadcast_spec(docs, path), lambda tok, text: (tok.encode(text),), schema)
    return id_and_text(docs, id_col, text_col).mapInArrow(tidied(run), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; a null list is an empty text."""
    spec = broadcast_spec(encoded, path)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        tok = None
        for batch in batches:
            tok = tok or load(spec.value)
            texts = [tok.decode(ids.as_py() or []) for ids in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(tidied(run), "doc_id bigint, text string")


def _digests(tok: Tokenizer, text: str) -> tuple[int, str, str]:
    parts = tok.parts(text)
    n, ids, labels = zip(*parts, strict=True) if parts else ((), (), ())
    decoded = b"".join(labels).decode("utf-8", "replace").encode()
    return sum(n), hashlib.sha256(b",".join(ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: each text encoded and decoded in one pass."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    run = over_batches(broadcast_spec(docs, path), _digests, schema)
    return id_and_text(docs, id_col, text_col).mapInArrow(tidied(run), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_bpe")
def op10_bpe(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents"), default_path())
