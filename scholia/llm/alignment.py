"""Cross-tokenizer alignment: tokens of two tokenizers over the same text, cut where both end, and counts of linked ids."""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from scholia.llm.bpe import byte_symbols
from scholia.llm.common import id_and_text, query, table, tidied
from scholia.session import cut_lineage

#: Both tokenizers start anew before a space that follows something else than white space, and before such a line end if B
#: has no piece with one; white space at the very end of a text stays with what precedes it.
SEGMENT = re.compile(r"[ \n][^ \n]*(?:(?:(?<=\s)[ \n]|[ \n]\Z)[^ \n]*)*")
SPACED = re.compile(r" [^ ]*(?:(?:(?<=\s) | \Z)[^ ]*)*")
ROWS = 256  # texts that a task works on at a time
KEEP_CHARS = 5_000_000  # characters of the segments that a task remembers
SIGNS = (b",", b"|", b";", b"")  # what follows an id: its group goes on, A's part ends, the group ends, the segment ends
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


class Pair:
    """Two tokenizers, the bytes of their tokens, and the alignment of segments.

    ``spec`` is a byte-level file of the tokenizers library, ``model`` a sentencepiece model without
    normalization that puts a space before the text. ``keys`` are all pairs ``a << 32 | b`` of ids whose bytes can
    end together: one token's bytes end the other's. Their number depends on the two vocabularies alone.
    """

    def __init__(self, spec: str, model: bytes, keys: np.ndarray | None = None):
        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = byte_symbols()
        added = {t["id"]: t["content"].encode() for t in json.loads(spec).get("added_tokens", [])}
        self.a_bytes = {i: bytes(byte_of[c] for c in s) for s, i in self.a.get_vocab(with_added_tokens=False).items() if i not in added} | added
        self.b_bytes, is_byte = [], []
        for i in range(self.b.vocab_size()):
            piece = self.b.IdToPiece(i)
            one = BYTE_PIECE.match(piece)
            self.b_bytes.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
            is_byte.append(bool(one))
        # A piece with a space after something else could reach over two segments: then a text is one segment.
        whole = any(re.search("[^ ] ", x.decode("utf-8", "replace")) for x in self.b_bytes)
        lines = any(b"\n" in x for x, one in zip(self.b_bytes, is_byte, strict=True) if not one)
        self.segments = (lambda text: [text]) if whole else (SPACED if lines else SEGMENT).findall
        self.keys = self.possible_pairs() if keys is None else keys
        self.a_size = np.zeros(1 + max(self.a_bytes, default=-1), np.int64)
        self.a_size[list(self.a_bytes)] = list(map(len, self.a_bytes.values()))
        self.b_size = np.array(list(map(len, self.b_bytes)), np.int64)
        self.names = [b"%d%s" % (i, sign) for n in (len(self.a_size), len(self.b_size)) for i in range(n) for sign in SIGNS]
        self.known: dict[str, tuple | None] = {}
        self.held = 0  # characters of the segments in it

    def possible_pairs(self) -> np.ndarray:
        a_of: dict[bytes, list[int]] = {}
        b_of: dict[bytes, list[int]] = {}
        for i, x in self.a_bytes.items():
            a_of.setdefault(x, []).append(i)
        for i, x in enumerate(self.b_bytes):
            b_of.setdefault(x, []).append(i)
        pairs = {i << 32 | j for x, own in a_of.items() for k in range(len(x)) for j in b_of.get(x[k:], ()) for i in own}
        pairs |= {i << 32 | j for x, own in b_of.items() for k in range(1, len(x)) for i in a_of.get(x[k:], ()) for j in own}
        return np.array(sorted(pairs), np.int64)

    def a_tokens(self, segments: list[str]) -> list[list[int]]:
        """Ids of the tokens of each segment."""
        return [x.ids for x in self.a.encode_batch_fast(segments, add_special_tokens=False)]

    def b_tokens(self, segments: list[str]) -> list[list[int]]:
        """As ``a_tokens``. The space that the model puts before a text is the segment's own, or goes if the segment has none."""
        told = self.b.encode([s.removeprefix(" ") for s in segments], out_type=int, num_threads=1)
        return [ids if s[0] == " " else ids[1:] for s, ids in zip(segments, told, strict=True)]

    def align(self, segments: list[str]) -> list[tuple[int, int, bytes, bytes] | None]:
        """``n_a, n_b, groups, links`` (packed numbers of pairs) of each segment; none where the tokens' bytes aren't the
        segment's. Where they are, a token ends at the sum of the lengths up to it, so the ends of all segments, laid one
        behind the other, are compared at once; every segment ends a group."""
        spell_a, spell_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        found: list = [
            (a, b) if a and b and b"".join(map(spell_a, a)) == (data := s.encode()) and b"".join(map(spell_b, b)) == data else None
            for s, a, b in zip(segments, self.a_tokens(segments), self.b_tokens(segments), strict=True)
        ]
        rows = [x for x in found if x]
        n_a, n_b = (np.array([len(x[i]) for x in rows], np.int64) for i in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(x[i] for x in rows), np.int64, n.sum()) for i, n in enumerate((n_a, n_b)))
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        place = np.searchsorted(a_ends, b_ends)
        last_b = np.flatnonzero(a_ends[place] == b_ends) if len(rows) else np.zeros(0, np.int64)
        last_a = place[last_b]
        links = np.searchsorted(self.keys, a[last_a] << 32 | b[last_b]).astype(np.int32).tobytes()
        # the tokens of a group, those of A before those of B, each with the sign that follows it
        many_a, many_b = (np.diff(x, prepend=-1) for x in (last_a, last_b))
        signs = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        signs[0][last_a], signs[1][last_b], signs[1][np.cumsum(n_b) - 1] = 1, 2, 3
        told = np.empty(len(a) + len(b), np.int64)
        told[np.arange(len(a)) + np.repeat(np.cumsum(many_b) - many_b, many_a)] = a * len(SIGNS) + signs[0]
        told[np.arange(len(b)) + np.repeat(np.cumsum(many_a), many_b)] = (b + len(self.a_size)) * len(SIGNS) + signs[1]
        names = list(map(self.names.__getitem__, told.tolist()))
        cuts = np.cumsum(n_a + n_b).tolist()
        n_links = (4 * np.searchsorted(last_b, np.cumsum(n_b) - 1, "right")).tolist()
        done = zip(n_a.tolist(), n_b.tolist(), [0, *cuts], cuts, [0, *n_links], n_links)
        parts = iter([(one, other, b"".join(names[i:j]), links[k:m]) for one, other, i, j, k, m in done])
        return [x and next(parts) for x in found]

    def learn(self, texts: list[list[str]]) -> None:
        """Aligns the segments of some texts that aren't known yet, each once. What is remembered stays bounded: beyond, only these
        texts' segments stay."""
        met = dict.fromkeys(chain.from_iterable(texts))
        new = [s for s in met if s not in self.known]
        self.known.update(zip(new, self.align(new), strict=True))
        self.held += sum(map(len, new))
        if self.held > KEEP_CHARS:
            self.known = {s: self.known[s] for s in met}
            self.held = sum(map(len, met))

    def texts(self, texts: list[str]) -> list[tuple[int, int, str, bytes]]:
        """``n_a, n_b, groups_sha256, links`` (packed numbers of pairs) of each text."""
        cut = [self.segments(" " + t) if t else [] for t in texts]
        self.learn(cut)
        out = []
        for segments in cut:
            rows = list(map(self.known.__getitem__, segments))
            if not rows or None in rows:
                out.append((0, 0, "", b""))
                continue
            n_a, n_b, groups, links = zip(*rows, strict=True)
            out.append((sum(n_a), sum(n_b), hashlib.sha256(b";".join(groups)).hexdigest(), b"".join(links)))
        return out

    def forget(self) -> None:
        self.known, self.held = {}, 0


_LOADED: dict[str, Pair] = {}


def load(files: tuple[str, bytes, np.ndarray]) -> Pair:
    """The compiled pair, once a worker; what it remembers of segments is dropped at the end of a task."""
    key = hashlib.md5(files[0].encode() + files[1]).hexdigest()
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        _LOADED[key] = Pair(*files)
    return _LOADED[key]


def read_whole(spark, path: str) -> bytes:
    """A vocabulary file: a plain path names a file beside the driver, an address one in a store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as f:
        return f.read()


ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links array<int>"


def align_texts(docs: DataFrame, files, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links``; ``links`` has the numbers of the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]):
        pair = load(files.value)
        often = gc.get_threshold()
        gc.set_threshold(500_000, 20, 20)  # what is remembered has no cycles to be looked for
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    n_a, n_b, told, links = zip(*pair.texts(batch["text"].to_pylist()), strict=True)
                    n = np.array([len(x) // 4 for x in links], np.int64)
                    ends = np.concatenate([[0], np.cumsum(n)])
                    yield pa.RecordBatch.from_arrays([
                        batch["doc_id"], pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(n), pa.array(n), pa.array(told, pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(links), np.int32))),
                    ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])
        finally:
            pair.forget()
            gc.set_threshold(*often)

    return id_and_text(docs, id_col, text_col).mapInArrow(tidied(run), ALIGNED)


def link_counts(aligned: DataFrame, n_pairs: int) -> np.ndarray:
    """How many links have each pair. A task sums into one array, so it sends a row per pair at most."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            total += np.bincount(batch["links"].flatten().to_numpy(), minlength=n_pairs)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["pair", "n"])

    parts = aligned.select("links").mapInArrow(tidied(run), "pair bigint, n bigint")
    met = parts.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_pairs, np.int64)
    out[met.column("pair").to_numpy()] = met.column("n").to_numpy()
    return out


def cross_alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Tokenizer A (``a_path``, byte-level, of the tokenizers library) encodes a space and the text, B (``b_path``, a sentencepiece
    model) the text. Where a token of A and one of B end at the same byte a group ends, and the two are
    linked. ``count_sum`` adds the links' counts over all documents, ``n_best`` counts the links whose count is the highest of
    their B id. A null or empty text, or one whose tokens don't spell a space and the text, has no tokens: zeros and an
    empty ``groups_sha256``. Ids may be null or repeat; an empty table gives no rows; other columns aren't read.

    Each text is encoded once; the links are written as numbers of pairs. The counts are one number for each pair of ids that
    can end together, which the two vocabularies bound (some hundred thousand, whatever the corpus), so they are
    collected and sent to every task.
    """
    spark = docs.sparkSession
    spec, model = read_whole(spark, a_path).decode(), read_whole(spark, b_path)
    keys = Pair(spec, model).keys
    files = spark.sparkContext.broadcast((spec, model, keys))
    aligned = cut_lineage(align_texts(docs, files, id_col, text_col))
    counts = link_counts(aligned, len(keys))
    highest = np.zeros(1 + int((keys & 0xFFFFFFFF).max(initial=0)), np.int64)
    np.maximum.at(highest, keys & 0xFFFFFFFF, counts)
    sent = spark.sparkContext.broadcast((counts, counts == highest[keys & 0xFFFFFFFF]))

    def run(batches: Iterator[pa.RecordBatch]):
        counts, best = sent.value
        for batch in batches:
            links = batch["links"].flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(batch["n_links"].to_numpy())])
            told = [np.concatenate([[0], np.cumsum(x[links])])[ends] for x in (best.astype(np.int64), counts)]
            columns = {name: batch[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            columns |= {"n_best": pa.array(np.diff(told[0])), "count_sum": pa.array(np.diff(told[1])), "groups_sha256": batch["groups_sha256"]}
            yield pa.RecordBatch.from_pydict(columns)

    return aligned.mapInArrow(tidied(run), "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op12_cross_alignment")
def op12_cross_alignment(spark, sf_dir):
    return cross_alignment(table(spark, sf_dir, "documents"), *default_paths())
