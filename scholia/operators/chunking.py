"""Chunkers, sentence splitting, and operators around user-supplied functions.

Cutting a text is sequential inside one document and parallel over documents; the helpers below do
one document, Spark does the rest.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from scholia.functions.batches import text_rows, tidied, to_batch
from scholia.functions.ids import chunk_id
from scholia.functions.text import strip
from scholia.functions.vectors import dot, norm
from scholia.operators.articles import enrich_chunks, pending
from scholia.operators.index import next_seq
from scholia.operators.pages import assign_pages, clean_pages, page_offsets, strip_repeated_lines
from scholia.operators.skew import numbered, running_total
from scholia.session import cut_lineage

CHUNK = "paper_id string, chunk_index bigint, char_start bigint, char_end bigint, text string"
CHUNK_TYPES = {"paper_id": pa.string(), "chunk_index": pa.int64(), "char_start": pa.int64(), "char_end": pa.int64(), "text": pa.string()}

# ---- sliding window ------------------------------------------------------------------------------

# Where a window may end, best first: behind a blank line, a sentence, a space. Length of each mark.
PLACES = ((re.compile(r"\n(?=\n)"), 2), (re.compile(r"[.!?](?=\s)"), 2), (re.compile(" "), 1))
SOLID = re.compile(r"[^ \n\t]")


class Cuts:
    """All places of one text where a window may end, found in one scan a kind."""

    def __init__(self, text: str, on_paragraph: bool):
        kinds = PLACES if on_paragraph else PLACES[1:]
        self.text = text
        self.places = [([m.start() + width for m in mark.finditer(text)], width) for mark, width in kinds]

    def near(self, target: int, reach: int) -> int:
        """The last place of the best kind from ``reach`` before ``target`` to half of it behind, else ``target``."""
        lo, hi = max(0, target - reach), min(len(self.text), target + reach // 2)
        for ends, width in self.places:
            k = bisect.bisect_right(ends, hi)
            if k and ends[k - 1] - width >= lo:
                return ends[k - 1]
        return target


def sliding_windows(
    pieces: Iterable[str], size: int, overlap: int, least: int, on_paragraph: bool, trim: bool = False
) -> Iterator[tuple[int, int, str]]:
    """``(start, end, text)`` of the windows over a document that arrives in pieces.

    Only the text a window can still touch is kept, so memory does not grow with the document. A
    window is final once solid text lies beyond everything its cut may look at. ``trim`` ignores
    white space at the end of the document.
    """
    buf, base, start = "", 0, 0

    def advance(total: int | None) -> Iterator[tuple[int, int, str]]:
        """The windows that are final; all of them once the length of the document is known."""
        nonlocal start
        cuts = Cuts(buf if total is None else buf[: total - base], on_paragraph)
        ahead = size if total is not None else size + overlap // 2 + 1
        limit = total if total is not None else base + len(buf.rstrip())
        while start + ahead <= limit and not (total is not None and start + size >= total):
            end = base + cuts.near(start + size - base, overlap)
            if len(body := buf[start - base : end - base].strip()) >= least:
                yield start, end, body
            if end == total:
                start = total
            elif end < overlap:  # the overlap would reach beyond the beginning
                start += 1
            else:
                again = SOLID.search(buf, end - overlap - base, end - base)
                start = max(start + 1, base + again.start() if again else end)
        if total is not None and start < total:
            if len(body := buf[start - base : total - base].strip()) >= least:
                yield start, total, body
            start = total

    for piece in pieces:
        buf += piece
        yield from advance(None)
        keep = max(0, start - overlap - base)
        buf, base = buf[keep:], base + keep
    total = base + len(buf.rstrip() if trim else buf)
    if total >= least:
        yield from advance(total)


def _check_sizes(size: int, overlap: int) -> None:
    if overlap >= size:
        raise ValueError(f"overlap {overlap} must be smaller than the window {size}")


def chunk_sliding(docs: DataFrame, size: int = 2000, overlap: int = 200, least: int = 100, on_paragraph: bool = True) -> DataFrame:
    """Overlapping windows of each document (``paper_id``, ``text``); no shuffle."""
    _check_sizes(size, overlap)

    def run(batches):
        for texts in text_rows(batches):
            rows = [
                (pid, i, *w)
                for pid, text in texts
                for i, w in enumerate(sliding_windows([text or ""], size, overlap, least, on_paragraph))
            ]
            yield to_batch(rows, **CHUNK_TYPES)

    chunks = docs.select("paper_id", "text").mapInArrow(tidied(run), CHUNK)
    return chunks.withColumn("chunk_id", chunk_id("paper_id", "chunk_index"))


def chunk_pages(pages: DataFrame, size: int = 2000, overlap: int = 200, least: int = 100, on_paragraph: bool = True) -> DataFrame:
    """Windows over the pages of each document, with the page each window starts on.

    Pages are sorted by document and streamed through the cutter, so a document of any number of
    pages passes with a buffer of one window.
    """
    _check_sizes(size, overlap)

    def run(batches):
        def rows():
            for pdf in batches:
                yield from zip(pdf["paper_id"], pdf["text"])

        out = []
        for pid, group in itertools.groupby(rows(), key=lambda r: r[0]):
            windows = sliding_windows((text + "\n\n" for _, text in group), size, overlap, least, on_paragraph, trim=True)
            for i, window in enumerate(windows):
                out.append((pid, i, *window))
                if len(out) >= 1000:
                    yield pd.DataFrame(out, columns=["paper_id", "chunk_index", "char_start", "char_end", "text"])
                    out = []
        yield pd.DataFrame(out, columns=["paper_id", "chunk_index", "char_start", "char_end", "text"])

    placed = pages.select(F.col("paper_id").cast("string"), "page_number", "text")
    ordered = placed.repartition("paper_id").sortWithinPartitions("paper_id", "page_number").select("paper_id", "text")
    chunks = ordered.mapInPandas(run, CHUNK).withColumn("chunk_id", chunk_id("paper_id", "chunk_index"))
    return assign_pages(chunks, page_offsets(placed))


# ---- sentences and semantic chunks ---------------------------------------------------------------

# Fixed value: end of a sentence; not behind these abbreviations.
SENTENCE_END = re.compile(r"(?<!\.\s)(?<!\betal)(?<!\be\.g)(?<!\bi\.e)(?<!\bvs)([.!?])\s+")


def sentence_parts(start: int, end: int, raw: str, cap: int) -> list[tuple[int, int, str, bool]]:
    """One sentence as it counts: nothing if blank; text without punctuation that is longer than ``cap`` is cut at the last
    space in the second half of the allowed length."""
    body = raw.strip()
    if len(body) <= cap:
        return [(start, end, body, False)] if body else []
    # A piece is the rest if it fits, else as much as ends before a space past the half, else ``cap`` characters.
    lots = re.compile(rf"(?s)(.{{1,{cap}}}\Z|.{{{int(cap * 0.5) + 1},{max(cap - 1, int(cap * 0.5) + 1)}}}(?= )|.{{1,{cap}}}) *")
    return [(start + m.start(1), start + m.end(1), m[1].strip(), True) for m in lots.finditer(body) if m[1].strip()]


def sentences(text: str, cap: int) -> list[tuple[int, int, str, bool]]:
    """``(start, end, text, table_like)`` of the sentences of a text."""
    marks = [m.end(1) for m in SENTENCE_END.finditer(text)]
    places = zip([0, *(e + 1 for e in marks)], [*marks, len(text)])
    return [part for start, end in places for part in sentence_parts(start, end, text[start:end], cap)]


def split_sentences(docs: DataFrame, cap: int = 1000) -> DataFrame:
    """Sentences of each document with their offsets."""

    types = {"paper_id": pa.string(), "pos": pa.int64(), "char_start": pa.int64(), "char_end": pa.int64(), "text": pa.string(), "table_like": pa.bool_()}

    def run(batches):
        for texts in text_rows(batches):
            yield to_batch([(p, i, *s) for p, text in texts for i, s in enumerate(sentences(text or "", cap))], **types)

    return docs.select("paper_id", "text").mapInArrow(
        tidied(run), "paper_id string, pos bigint, char_start bigint, char_end bigint, text string, table_like boolean"
    )


def semantic_breaks(vectors: DataFrame, threshold: float = 0.15, by: str = "paper_id", pos: str = "seq") -> DataFrame:
    """Positions after which the next vector of the document points elsewhere.

    Neighbours meet through a join on (document, next number), unique on both sides, instead of a
    window over the whole document.
    """
    v = numbered(vectors.select(by, pos, "embedding"), [by], pos, "__n")
    following = v.select(by, (F.col("__n") - 1).alias("__n"), F.col("embedding").alias("__next"))
    cos = dot("embedding", "__next") / ((norm("embedding") + 1e-8) * (norm("__next") + 1e-8))
    return v.join(following, [by, "__n"]).withColumn("similarity", cos).where(F.col("similarity") < threshold).select(by, pos, "similarity")


def next_ends(before: np.ndarray, kind: np.ndarray, breaks: np.ndarray, least: int, most: int) -> np.ndarray:
    """For every sentence the end of a chunk that starts there: at a break once ``least`` is reached, before ``most``
    overflows, and always between table-like text and prose. ``before`` counts the characters before each sentence and at the end."""
    n = len(kind)
    first = np.arange(n)
    kind_ends = np.append(np.flatnonzero(kind[1:] != kind[:-1]) + 1, n)
    break_ends = np.append(np.flatnonzero(breaks) + 1, n)
    enough = np.maximum(np.searchsorted(before, before[:n] + least), first + 1)  # the first end with ``least`` characters
    full = np.searchsorted(before, before[:n] + most)  # the first end with ``most``
    # the last sentence stays out if it would overflow a chunk that is long enough without it
    over = (full <= n) & (before[np.minimum(full, n)] > before[:n] + most) & (full - 1 >= enough)
    turn = break_ends[np.minimum(np.searchsorted(break_ends, enough), len(break_ends) - 1)]
    return np.minimum.reduce([np.full(n, n), full - over, kind_ends[np.searchsorted(kind_ends, first, side="right")], turn])


def joins_before(before: np.ndarray, kind: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Sentences from which a short rest goes to the end of the text; it joins the chunk before it, if of its kind."""
    n = len(kind)
    same = np.append(False, kind[:-1] == kind[-1])
    return np.append(same & (ends == n) & (before[n] - before[:n] < least), False)


def group_sentences(parts: list, breaks: np.ndarray, least: int, most: int) -> list[tuple[int, int, str]]:
    """Sentences to chunks by ``next_ends``; a short rest joins the chunk before it."""
    if not parts:
        return []
    kind = np.array([p[3] for p in parts])
    before = np.concatenate([[0], np.cumsum([len(p[2]) + 1 for p in parts])])
    following = next_ends(before, kind, breaks, least, most)
    short = joins_before(before, kind, following, least)
    out, first = [], 0
    while first < len(parts):
        end = following[first]
        end = len(parts) if short[end] else int(end)
        out.append((parts[first][0], parts[end - 1][1], " ".join(p[2] for p in parts[first:end]).strip()))
        first = end
    return out


def similar_neighbours(encode, texts: list[str], threshold: float) -> np.ndarray:
    """Whether each text but the last is followed by one of another meaning."""
    m = np.asarray(encode(texts), dtype=np.float64).reshape(len(texts), -1)
    m = m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-8)
    return (m[:-1] * m[1:]).sum(axis=1) < threshold


def chunk_semantic(
    docs: DataFrame, encoder: Callable[[], Callable[[list[str]], np.ndarray]], threshold: float = 0.15, least: int = 300, most: int = 1000,
) -> DataFrame:
    """Chunks that end where neighbouring sentences differ in meaning. ``encoder()`` is called once
    per task and gives the function from texts to vectors; no shuffle."""

    def run(batches):
        encode = encoder()
        for texts in text_rows(batches):
            rows = []
            for pid, text in texts:
                if not text or len(text) < least:
                    continue
                parts = sentences(text, most)
                breaks = similar_neighbours(encode, [p[2] for p in parts], threshold)
                rows += [(pid, i, *g) for i, g in enumerate(group_sentences(parts, breaks, least, most))]
            yield to_batch(rows, **CHUNK_TYPES)

    chunks = docs.select("paper_id", "text").mapInArrow(tidied(run), CHUNK)
    return chunks.withColumn("chunk_id", chunk_id("paper_id", "chunk_index"))


PART = "paper_id string, char_start bigint, char_end bigint, text string, table_like boolean"


def page_sentences(pages: DataFrame, cap: int, least: int = 0) -> DataFrame:
    """Sentences of documents given by pages (numbers unique in a document), as of the pages joined by blank lines.

    Where sentences end is seen in the page alone. What stands before a page's first end and behind its
    last one meets the neighbouring pages' rows under the number of the sentence, the count of ends
    before it; so a task holds a page or a sentence, never a document. Pages without text or document are left
    out, and documents of fewer than ``least`` characters.
    """
    pages = pages.where("paper_id IS NOT NULL AND text IS NOT NULL")
    lengths = pages.groupBy("paper_id").agg((F.sum(F.length("text") + 2) - 2).alias("n_chars")).where(F.col("n_chars") >= max(least, 1))

    def cut(batches):
        for pdf in batches:
            rows = []
            for pid, number, text, at, n_chars in zip(*(pdf[c] for c in ("paper_id", "page_number", "text", "char_start", "n_chars"))):
                text += "\n\n"
                marks = [m.end(1) for m in SENTENCE_END.finditer(text)]
                for i, (a, b) in enumerate(zip([0, *(e + 1 for e in marks)], [*marks, len(text)])):
                    rows.append((pid, number, i, len(marks), at + a, min(at + b, n_chars), text[a:b]))
            yield pd.DataFrame(rows, columns=["paper_id", "page_number", "piece", "n_ends", "char_start", "char_end", "text"])

    def parts(batches):
        for pdf in batches:
            rows = [(pid, *part) for pid, a, b, raw in zip(*(pdf[c] for c in ("paper_id", "char_start", "char_end", "text"))) for part in sentence_parts(a, b, raw, cap)]
            yield pd.DataFrame(rows, columns=["paper_id", "char_start", "char_end", "text", "table_like"])

    placed = page_offsets(pages).drop("char_end").join(lengths, "paper_id")
    schema = "paper_id string, page_number bigint, piece bigint, n_ends bigint, char_start bigint, char_end bigint, text string"
    pieces = cut_lineage(placed.mapInPandas(cut, schema))
    at_edge = (F.col("piece") == 0) | (F.col("piece") == F.col("n_ends"))
    counted = running_total(pieces.where("piece = 0").select("paper_id", "page_number", "n_ends"), ["paper_id"], "page_number", F.col("n_ends"), "ends_before")
    edges = pieces.where(at_edge).join(counted.drop("n_ends"), ["paper_id", "page_number"]).withColumn("number", F.col("ends_before") + F.col("piece"))
    joined = edges.groupBy("paper_id", "number").agg(
        F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.sort_array(F.collect_list(F.struct("page_number", "text"))).alias("pieces")
    )
    columns = ["paper_id", "char_start", "char_end", "text"]
    joined = joined.withColumn("text", F.array_join(F.transform("pieces", lambda p: p["text"]), "")).select(*columns)
    return pieces.where(~at_edge).select(*columns).union(joined).mapInPandas(parts, PART)


def _grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows sorted by ``keys``, one at a time."""
    held, own = [], None
    for pdf in batches:
        for key, part in pdf.groupby(keys, sort=False):
            if held and key != own:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
            own = key
    if held:
        yield pd.concat(held, ignore_index=True)


def chunk_semantic_pages(
    pages: DataFrame, encoder, threshold: float = 0.15, least: int = 300, most: int = 1000, block: int = 1_000_000,
) -> DataFrame:
    """Semantic chunks of documents given by pages, with the page each chunk starts on.

    The rows of ``chunk_semantic`` over the joined pages, with a document cut into ranges of ``block`` characters of its sentences:

    * where a chunk that starts at a sentence ends depends on a bounded stretch behind it, so each range, with
      that stretch of the next one, gives the end of every possible chunk; neighbours are encoded there;
    * a chunk that runs over the end of a range ends within that stretch. For each sentence near its beginning a range tells where
      chunks begun there leave it, and how many they are; a document's ranges are then followed by these few numbers alone;
    * each range writes the chunks that start in it.

    No task holds more than a range (or one page, or one sentence). Any ``block`` gives the same rows.
    """
    reach = 3 * (most + 1) + least  # two chunks' ends, and whether a short rest follows
    block = max(block, reach)
    placed = pages.select(F.col("paper_id").cast("string"), "page_number", "text")
    parts = cut_lineage(page_sentences(placed, most, least))
    width = F.length("text") + 1
    totals = parts.groupBy("paper_id").agg(F.sum(width).alias("total"))
    parts = running_total(parts, ["paper_id"], "char_start", width, "before", 1 << 16).join(totals, "paper_id")
    home = F.floor(F.col("before") / block)
    ranges = F.when((home > 0) & (F.col("before") - home * block < reach), F.array(home, home - 1)).otherwise(F.array(home))
    parts = parts.withColumn("home", home).withColumn("range", F.explode(ranges))
    keys = ["paper_id", "range"]

    def look(batches):
        encode = encoder()
        for g in _grouped(batches, keys):
            texts, kind = g["text"].tolist(), g["table_like"].to_numpy(dtype=bool)
            before = np.append(g["before"].to_numpy(), g["before"].iloc[-1] + len(texts[-1]) + 1)
            n, own = len(texts), int((g["home"] == g["range"]).sum())
            ends = next_ends(before, kind, similar_neighbours(encode, texts, threshold), least, most)
            if before[n] == g["total"].iloc[0]:
                ends = np.where(joins_before(before, kind, ends, least)[ends], n, ends)
            out, count = np.zeros(own, dtype=np.int64), np.ones(own, dtype=np.int64)
            for i in range(own - 1, -1, -1):
                if ends[i] < own:
                    out[i], count[i] = out[ends[i]], count[ends[i]] + 1
                else:
                    out[i] = before[ends[i]]
            start = g["range"].iloc[0] * block
            near = int(np.searchsorted(before[:own], start + reach)) if start else 1
            told = [[before[:near].tolist(), out[:near].tolist(), count[:near].tolist()]] + [[None] * 3] * (n - 1)
            g = g.assign(chunk_end=before[ends], starts=[t[0] for t in told], leaves=[t[1] for t in told], counts=[t[2] for t in told])
            yield g[[*keys, "before", "char_start", "char_end", "text", "chunk_end", "starts", "leaves", "counts"]]

    def follow(batches):
        pid, entry, index = None, 0, 0
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if r.paper_id != pid:
                    pid, entry, index = r.paper_id, 0, 0
                at = bisect.bisect_left(r.starts, entry)
                if at < len(r.starts) and r.starts[at] == entry:
                    rows.append((pid, r.range, entry, index))
                    entry, index = r.leaves[at], index + r.counts[at]
            yield pd.DataFrame(rows, columns=[*keys, "entry", "first_index"])

    def write(batches):
        for g in _grouped(batches, keys):
            texts, chunk_end = g["text"].tolist(), g["chunk_end"].to_numpy()
            before = np.append(g["before"].to_numpy(), g["before"].iloc[-1] + len(texts[-1]) + 1)
            stop = (g["range"].iloc[0] + 1) * block
            a, index, rows = int(np.searchsorted(before, g["entry"].iloc[0])), int(g["first_index"].iloc[0]), []
            while a < len(texts) and before[a] < stop:
                b = int(np.searchsorted(before, chunk_end[a]))
                rows.append((g["paper_id"].iloc[0], index, g["char_start"].iloc[a], g["char_end"].iloc[b - 1], " ".join(texts[a:b]).strip()))
                a, index = b, index + 1
            yield pd.DataFrame(rows, columns=["paper_id", "chunk_index", "char_start", "char_end", "text"])

    lists = "starts array<bigint>, leaves array<bigint>, counts array<bigint>"
    looked = parts.repartition(*keys).sortWithinPartitions(*keys, "before").mapInPandas(
        look, f"paper_id string, range bigint, before bigint, char_start bigint, char_end bigint, text string, chunk_end bigint, {lists}"
    )
    looked = cut_lineage(looked)
    told = looked.where("starts IS NOT NULL").select(*keys, "starts", "leaves", "counts")
    entries = told.repartition("paper_id").sortWithinPartitions(*keys).mapInPandas(follow, "paper_id string, range bigint, entry bigint, first_index bigint")
    entered = looked.drop("starts", "leaves", "counts").join(cut_lineage(entries), keys)
    chunks = entered.repartition(*keys).sortWithinPartitions(*keys, "before").mapInPandas(write, CHUNK)
    return assign_pages(chunks.withColumn("chunk_id", chunk_id("paper_id", "chunk_index")), page_offsets(placed))


# ---- user-supplied functions ---------------------------------------------------------------------


def hashing_encoder(dim: int = 64) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A deterministic encoder without model files: signed word hashes, unit length."""

    def make():
        def encode(texts: list[str]) -> np.ndarray:
            m = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                for word in text.lower().split():
                    h = zlib.crc32(word.encode())
                    m[row, h % dim] += 1.0 if h & 0x40000000 else -1.0
            norms = np.linalg.norm(m, axis=1, keepdims=True)
            return m / np.where(norms == 0, 1.0, norms)

        return encode

    return make


def embed(df: DataFrame, text: str = "text", encoder=None, model: str = "hashing", batch: int = 64, dim: int = 64) -> DataFrame:
    """Vector, model and dimension columns; ``encoder()`` runs once per worker. Blank text fails."""
    encoder = encoder or hashing_encoder(dim)

    @pandas_udf(T.ArrayType(T.FloatType()))
    def vectors(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for texts in series:
            values = texts.tolist()
            parts = [np.asarray(encode(values[i : i + batch]), dtype=np.float32) for i in range(0, len(values), batch)]
            yield pd.Series([row for part in parts for row in part])

    blank = F.coalesce(F.length(strip(text)) == 0, F.lit(True))
    checked = F.when(blank, F.raise_error(F.lit("cannot embed empty text"))).otherwise(F.col(text))
    return df.withColumn("embedding", vectors(checked)).withColumn("model", F.lit(model)).withColumn("dim", F.size("embedding"))


def generate(df: DataFrame, prompt: str, client: Callable[[], Callable[[str, str], str]], system: str = "") -> DataFrame:
    """Answer or error per prompt; ``client()`` is opened once per task."""
    fields = df.schema.fields
    schema = T.StructType([*fields, T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())])

    def run(batches):
        ask = client()

        def one(text):
            try:
                return ask(system, text), None
            except Exception as e:  # noqa: BLE001 - the failure of one row is data
                return None, f"{type(e).__name__}: {e}"

        for pdf in batches:
            results = [one(p) for p in pdf[prompt]]
            yield pdf.assign(answer=[a for a, _ in results], error=[e for _, e in results])

    return df.mapInPandas(run, schema)


class _Blocks(HTMLParser):
    """Visible text of a page, one line per block element."""

    BREAKS = {"p", "div", "li", "h1", "h2", "h3", "br", "tr", "article", "nav", "title", "body"}
    HIDDEN = {"script", "style"}

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN
        if tag in self.BREAKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in self.HIDDEN and self.hidden > 0
        if tag in self.BREAKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def text_pages(content: bytes) -> list[tuple[int, str]]:
    """Default extractor: HTML or plain text, a form feed starts a page."""
    text = content.decode("utf-8")
    if text.lstrip()[:1] == "<":
        parser = _Blocks()
        parser.feed(text)
        text = re.sub(r"\s*\n\s*", "\n", "".join(parser.out)).strip()
    return [(i, page.strip()) for i, page in enumerate(text.split("\f"), start=1)]


def extract_pages(docs: DataFrame, extractor: Callable[[bytes], list[tuple[int, str]]] = text_pages) -> DataFrame:
    """Pages of binary documents (``paper_id``, ``content``); a failing document gives an error row."""

    def run(batches):
        for pdf in batches:
            rows = []
            for pid, content in zip(pdf["paper_id"], pdf["content"]):
                try:
                    rows += [(pid, number, text, None) for number, text in extractor(bytes(content))]
                except Exception as e:  # noqa: BLE001 - the failure of one document is data
                    rows.append((pid, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["paper_id", "page_number", "text", "error"]).astype({"page_number": "Int64"})

    return docs.select("paper_id", "content").mapInPandas(run, "paper_id string, page_number bigint, text string, error string")


def index_documents(
    docs: DataFrame, registry: DataFrame | None = None, done: DataFrame | None = None, *, extractor=text_pages, encoder=None, size: int = 2000, overlap: int = 200, least: int = 100,
    least_page: int = 50,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole build from binary documents to searchable chunks: chunks, failures, run summary.

    Skips documents already indexed (``done(paper_id, seq)``, or only ``paper_id`` for an index that isn't
    numbered), extracts and cleans pages, removes running lines, cuts windows, adds bibliographic fields,
    embeds, and numbers the chunks by document and place after those that are indexed: ``seq`` and
    ``total_chunks`` are what the searches and ``write_index`` need. Extraction and embedding are the
    costly steps and their results are read several times, so they are written once. The summary has one
    row: documents ``processed``, ``skipped`` and ``failed``, and ``chunks``.
    """
    todo = docs if done is None else pending(docs, done, "paper_id")
    extracted = cut_lineage(extract_pages(todo, extractor))
    pages = clean_pages(extracted.where(F.col("error").isNull()).drop("error"), least_page)
    chunks = chunk_pages(strip_repeated_lines(pages, least_page), size, overlap, least)
    if registry is not None:
        chunks = enrich_chunks(chunks, registry)
    errors = extracted.where(F.col("error").isNotNull()).select("paper_id", F.col("error").alias("reason"))
    empty = todo.select("paper_id").join(pages.select("paper_id").distinct(), "paper_id", "left_anti")
    empty = empty.join(errors.select("paper_id"), "paper_id", "left_anti").select("paper_id", F.lit("no usable page").alias("reason"))
    failed = errors.unionByName(empty)
    embedded = embed(chunks, encoder=encoder)
    # by document and place: documents in order of their ids, a range of the sorted rows a task
    embedded = embedded.withColumn("__o", F.struct("paper_id", "chunk_index"))
    placed = numbered(embedded, [], "__o", "__n").drop("__o")
    after = next_seq(done) if done is not None and "seq" in done.columns else F.lit(0).cast("bigint")
    totals = placed.groupBy("paper_id").agg(F.count("*").alias("total_chunks"))
    placed = placed.withColumn("seq", F.col("__n") + after).drop("__n").join(totals, "paper_id")
    count = lambda df: df.agg(F.count("*")).scalar()
    summary = placed.agg(F.count("*").alias("chunks"), F.count_distinct("paper_id").alias("processed")).select(
        "processed", (count(docs) - count(todo)).alias("skipped"), count(failed.select("paper_id").distinct()).alias("failed"), "chunks"
    )
    return placed, failed, summary


# ---- front matter --------------------------------------------------------------------------------


def front_matter(docs: DataFrame, text: str = "text") -> DataFrame:
    """Title, abstract, author lines and year guessed from the text of a document."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    first = F.get(lines, 0)
    shorter = F.get(F.filter(F.slice(lines, 2, 4), lambda x: (F.length(x) > 20) & (F.length(x) < 200)), 0)
    title = F.when(F.length(first) > 200, F.coalesce(shorter, first)).otherwise(first)
    abstract = F.nullif(strip(F.regexp_extract(text, r"(?is)(?:abstract|summary)\s*:?\s*([^.]{100,500}\.)", 1)), F.lit(""))
    year = F.nullif(F.regexp_extract(text, r"\b(?:19|20)[0-9]{2}\b", 0), F.lit("")).try_cast("int")
    head = F.transform(F.slice(F.split(text, "\n"), 1, 20), strip)
    # Words that rule a line out as authors.
    not_authors = "(?i)abstract|introduction|address|university"
    named = F.filter(
        head, lambda x: (F.length(x) > 5) & (F.length(x) < 100) & x.rlike(r"\p{Lu}") & x.rlike(r"\p{Ll}") & ~x.rlike(not_authors)
    )
    bare = F.transform(F.slice(named, 1, 5), lambda x: strip(F.regexp_replace(x, r"\([^)]*\)", "")))
    authors = F.filter(bare, lambda x: F.length(x) > 3)
    return docs.select("paper_id", title.alias("title"), abstract.alias("abstract"), authors.alias("authors"), year.alias("year"))
