import hashlib
import tarfile
import zlib
from urllib.parse import urlparse

import numpy as np
import pytest

from corpusloom.llm import media

TEXTS = ["satu", "satu", "", None, "é" * 500, "x" * 192, "x" * 193, "kata " * 60_000]


def test_query_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "satu", 0)], "doc_id long, text string, digest int")
    rows = {r["doc_id"]: r for r in media.query(df).collect()}
    assert len(rows) == 9
    for i, t in [*enumerate(TEXTS), (None, "satu")]:
        raw = (t or "").encode()
        data = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]))
        assert (r["width"], r["height"], r["bits"]) == (192, len(data) // 192, 8)
        png = media.png_encode(data)
        assert (r["media_bytes"], r["media_sha256"]) == (len(png), hashlib.sha256(png).hexdigest())
    assert rows[0][2:] == rows[1][2:] == rows[None][2:]


def test_shards_are_tar_files_and_rows_point_into_them(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS * 4)), "doc_id long, text string").repartition(3)
    folder = media.new_folder(df)
    manifest = media.write_shards(df, folder, limit=2000)
    rows = manifest.collect()
    path = urlparse(folder).path
    assert len({r["shard"] for r in rows}) > 3
    for r in rows:
        with open(f"{path}/{r['shard']}", "rb") as f:
            f.seek(r["offset"])
            samples = media.png_decode(f.read(r["length"]))
        assert hashlib.sha256(samples.tobytes()).digest() == bytes(r["digest"])
        with tarfile.open(f"{path}/{r['shard']}") as tar:
            assert tar.getmember(f"{bytes(r['digest']).hex()}.png").offset_data == r["offset"]
    one = media.canonical(manifest)
    assert one.count() == len({t or "" for t in TEXTS})
    assert {(r["width"], r["bits"]) for r in media.metadata(one, folder).collect()} == {(192, 8)}


def test_damage_is_noticed():
    png = bytearray(media.png_encode(media.payload(b"teks")))
    assert media.png_header(bytes(png[:33])) == (192, 1, 8)
    png[45] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        media.png_decode(bytes(png))
    with pytest.raises(ValueError, match="header"):
        media.png_header(b"x" * 33)


def test_feature():
    assert media.feature(np.zeros((1, 192), np.uint8)) == "mean=0.000000;sd=0.000000;hist=192,0,0,0,0,0,0,0"


def test_empty_table(spark):
    assert media.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0
