"""Media columns: interleaved text and media sequences of HTML documents.

Parsing gives each document an ordered sequence of elements: runs of text, and references to media with their caption. A reference names its
payload by digest (`sha256:<hex>`); a digest join resolves it against a media store. Every payload is described once, however many documents
refer to it: the store has one row per digest, and the join carries descriptions (or payloads, if the store has that column) to the references.
Positions are those of the sequence, so text, media and captions stay aligned whatever order rows come in.

The store keeps payloads as 8-bit grey PNG images 64 samples wide: lossless, checksummed, and read back before anything is computed from them.

Defined results: null or empty text is a payload of 64 zero bytes; null HTML is an empty sequence; unknown digests keep their place with null
descriptions; equal texts share one row of the store and have equal values (texts that differ in final zero bytes alone differ in n_bytes);
repeated rows and null ids each have their own sequence; a text of any length is one payload, with memory in proportion to it; empty tables
give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episoda.functions import png
from episoda.llm import common

WIDTH = 64
_LEVEL = 6

#: Elements of HTML whose content is not text, those that end a run of text, and those that refer to media.
_SILENT = {"script", "style", "template", "noscript", "head", "title"}
_BREAKS = {"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "table", "tr", "td", "th", "blockquote", "figure", "figcaption", "header", "footer", "nav", "pre", "hr", "main", "aside", "body"}
_MEDIA = {"img": "image", "video": "video", "audio": "audio", "source": "source", "embed": "embed"}

SEQUENCE = "elements array<struct<position:int,kind:string,text:string,reference:string,digest:string,caption:string>>"


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.run: list[str] = []
        self.silent = 0
        self.figure: int | None = None
        self.caption: list[str] | None = None

    def _flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.out.append({"kind": "text", "text": text, "reference": None, "digest": None, "caption": None})

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += 1
        if tag in _BREAKS or tag in _MEDIA:
            self._flush()
        if tag == "figure":
            self.figure = len(self.out)
        elif tag == "figcaption":
            self.caption = []
        elif tag in _MEDIA and not self.silent:
            a = dict(attrs)
            reference = a.get("src") or a.get("data-src")
            if reference:
                digest = reference[7:].lower() if reference.lower().startswith("sha256:") else None
                self.out.append({"kind": _MEDIA[tag], "text": None, "reference": reference, "digest": digest, "caption": a.get("alt") or None})

    def handle_startendtag(self, tag, attrs):
        if tag not in _SILENT:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        if tag == "figcaption" and self.caption is not None:
            text, self.caption = " ".join("".join(self.caption).split()), None
            for x in self.out[self.figure or 0 :] if self.figure is not None else []:
                if x["kind"] != "text" and text:
                    x["caption"] = text
        elif tag == "figure":
            self.figure = None
        if tag in _BREAKS:
            self._flush()

    def handle_data(self, data):
        if self.caption is not None:
            self.caption.append(data)
        elif not self.silent:
            self.run.append(data)


def parse(html: str) -> list[dict]:
    """The ordered elements of a document; a figure's caption belongs to the media in it, otherwise the alternative text is the caption."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader._flush()
    return [{"position": i, **x} for i, x in enumerate(reader.out)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("position", pa.int32()), *((n, pa.string()) for n in ("kind", "text", "reference", "digest", "caption"))]))
    for batch in common.slices(batches, "html"):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([parse(x) for x in common.texts(batch, "html")], kind)], ["doc_id", "elements"])


def sequences(pages: DataFrame) -> DataFrame:
    """pages(doc_id, html) as doc_id and its ordered elements."""
    return pages.select(F.col("doc_id").cast("long"), "html").mapInArrow(_parse, f"doc_id long, {SEQUENCE}")


def resolve(parsed: DataFrame, store: DataFrame) -> DataFrame:
    """One row per element: doc_id, position, kind, text, reference, digest, caption, and the store's columns for its digest (null if unknown).

    The store has one row per digest. A digest that a third of all references share is a hot key of the left side only, which adaptive
    execution splits; the store is written first so that both sides are plain exchanges.
    """
    rows = parsed.select("doc_id", F.explode("elements").alias("e")).select("doc_id", "e.*")
    return rows.join(store, "digest", "left")


def payload_of(text: bytes) -> bytes:
    """The bytes of a text, padded with zeros to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % WIDTH if text else WIDTH)


def store_bytes(payload: bytes) -> bytes:
    return png.encode(np.frombuffer(payload, np.uint8).reshape(-1, WIDTH), _LEVEL)


def read_bytes(stored: bytes) -> bytes:
    pixels = png.decode(stored)
    if pixels.shape[1:] != (WIDTH, 1):
        raise png.PngError("not a payload image")
    return pixels.tobytes()


def feature_of(payload: bytes) -> str:
    """Mean, deviation, byte entropy, share of zero samples, and a 64-bit average hash of 64 equal parts of the samples."""
    x = np.frombuffer(payload, np.uint8)
    counts = sum(np.bincount(x[at : at + (1 << 20)], minlength=256) for at in range(0, len(x), 1 << 20))
    p = counts[counts > 0] / len(x)
    mean = float((counts * np.arange(256)).sum()) / len(x)
    sd = float(np.sqrt((counts * (np.arange(256) - mean) ** 2).sum() / len(x)))
    edges = [k * len(x) // 64 for k in range(65)]
    parts = [int(x[a:b].sum(dtype=np.int64)) for a, b in zip(edges, edges[1:], strict=False)]
    total = sum(parts)
    bits = "".join("1" if v * 64 >= total else "0" for v in parts)
    return f"mean={mean:.4f};sd={sd:.4f};entropy={-(p * np.log2(p)).sum():.4f};zeros={counts[0] / len(x):.4f};hash={int(bits, 2):016x}"


_STORED = "digest string, n_bytes long, media binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, "text"):
        seen: dict[str, tuple[int, bytes]] = {}
        for raw in common.raw_texts(batch):
            payload = payload_of(raw)
            digest = hashlib.sha256(raw).hexdigest()
            if digest not in seen:  # copies in one slice meet before the shuffle
                seen[digest] = (len(raw), store_bytes(payload))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.binary())], [x.split()[0] for x in _STORED.split(", ")])


def text_media(docs: DataFrame) -> DataFrame:
    """The media store of docs(text): digest (of the text's bytes), n_bytes (unpadded), media (the stored form); one row per distinct text."""
    made = docs.select("text").mapInArrow(_encode, _STORED)
    return made.groupBy("digest").agg(F.first("n_bytes").alias("n_bytes"), F.first("media").alias("media"))


DESCRIBED = "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, "media"):
        rows = []
        for digest, n, stored in zip(*(batch.column(c).to_pylist() for c in ("digest", "n_bytes", "media")), strict=True):
            payload = read_bytes(stored)
            rows.append((digest, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(payload)))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in DESCRIBED.split(", ")])


def describe(store: DataFrame) -> DataFrame:
    """What the stored media hold, read back from their bytes: sizes, checksums and a feature string, one row per digest."""
    return store.mapInArrow(_describe, DESCRIBED)


def document_markup(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) as interleaved HTML: a lead, and a figure that refers to the text's stored payload by digest."""
    digest = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    caption = F.concat(F.lit("payload of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?")))
    html = F.concat(F.lit("<article><p>Document</p><figure><img src='sha256:"), digest, F.lit("'><figcaption>"), caption, F.lit("</figcaption></figure></article>"))
    return docs.select(F.col("doc_id").cast("long"), html.alias("html"))


def document_media(docs: DataFrame) -> DataFrame:
    """One row per document: its media reference resolved against the described store of all documents."""
    described = common.materialise(describe(text_media(docs)), "media")
    parsed = common.materialise(sequences(document_markup(docs)), "sequences")
    return resolve(parsed, described).where(F.col("kind") == "image").drop("digest", "text", "reference")


def markup_of(elements: list[dict]) -> str:
    """HTML whose parse is these elements again."""
    out = []
    for x in elements:
        if x["kind"] == "text":
            out.append(f"<p>{escape(x['text'])}</p>")
        else:
            tag = {v: k for k, v in _MEDIA.items()}[x["kind"]]
            alt = f' alt="{escape(x["caption"])}"' if x["caption"] else ""
            out.append(f'<{tag} src="{escape(x["reference"])}"{alt}>')
    return "".join(out)
