"""Stored pictures: both forms on the query's path, tiles and hashes by hand, broken pictures."""

from __future__ import annotations

import hashlib
import io
import zlib

import numpy as np

from lectern.llm import media


def test_dealt_forms_and_digests(spark):
    texts = [(1, None), (2, ""), *((i, f"text {i} é" * i) for i in range(3, 30)), (40, "text 3 é" * 3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    stored = media.text_media(docs, form="dealt")
    forms = {r.doc_id: bytes(r.media[:2]) for r in stored.collect()}
    assert set(forms.values()) == {b"P5", b"BM"} and forms[3] == forms[40] and forms[1] == forms[2]
    for r in media.payload_digests(media.media_tiles(stored)).collect():
        payload = (dict(texts)[r.doc_id] or "").encode()
        payload += bytes(-len(payload) % 64 if payload else 64)
        samples = np.frombuffer(payload, np.uint8).reshape(-1, 64)
        form = (media.encode_bmp if forms[r.doc_id] == b"BM" else media.encode_pgm)(samples)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(form), hashlib.sha256(form).hexdigest())
        tile = np.load(io.BytesIO(r.tile_npy))
        assert tile.shape == media.TILE and np.abs(tile - plain_resize(samples, *media.TILE)).max() <= 0.5 + 1e-6
        assert r.dhash == plain_hash(tile)


def plain_resize(samples, height, width):
    """Mean over each target pixel's area, pixel by pixel."""
    out = np.zeros((height, width))
    h, w = samples.shape
    for i in range(height):
        for j in range(width):
            y0, y1, x0, x1 = i * h / height, (i + 1) * h / height, j * w / width, (j + 1) * w / width
            total = area = 0.0
            for y in range(int(y0), min(h, int(np.ceil(y1)))):
                for x in range(int(x0), min(w, int(np.ceil(x1)))):
                    part = max(0.0, min(y + 1, y1) - max(y, y0)) * max(0.0, min(x + 1, x1) - max(x, x0))
                    total, area = total + part * float(samples[y, x]), area + part
            out[i, j] = total / area
    return np.round(out, 9)


def plain_hash(tile):
    bits = "".join("1" if a < b else "0" for row in tile.tolist() for a, b in zip(row, row[1:], strict=False))
    return f"{int(bits, 2):0{-(-len(bits) // 4)}x}"


def test_broken_pictures(spark):
    pictures = spark.createDataFrame([(1, None), (2, b"P2 1 1 255 300"), (3, b""), (4, b"BM"), (5, b"P5\n1 1\n255\nA")], "i int, media binary")
    got = {r.i: r for r in media.payload_digests(media.media_tiles(pictures)).collect()}
    assert got[5].payload_bytes == 1 and got[5].media_error is None
    assert got[1].media_bytes is None and all(got[i].payload_sha256 is None and got[i].media_error for i in (1, 2, 3, 4)) and got[2].media_bytes == 14
