import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.llm.sharding import hilbert_index, hilbert_shards, octave_cell, string_cell, string_cuts, write_shards


def index(x, bits):
    """The curve's index by bit tricks on one point."""
    x, n = list(x), len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for bit in reversed(range(bits)):
        for v in x:
            out = out << 1 | ((v ^ t) >> bit & 1)
    return out


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (3, 8)])
def test_index(spark, dimensions, bits):
    rng = random.Random(bits)
    names = [f"c{i}" for i in range(dimensions)]
    points = [tuple(rng.randrange(1 << bits) for _ in names) for _ in range(200)]
    frame = spark.createDataFrame(points, ", ".join(f"{n} int" for n in names))
    got = frame.select(*names, hilbert_index([F.col(n) for n in names], bits).alias("h")).collect()
    assert all(row.h == index(tuple(row)[:-1], bits) for row in got)


def test_curve_visits_neighbours():
    cells = sorted((index((x, y, z), 3), x, y, z) for x in range(8) for y in range(8) for z in range(8))
    assert [c[0] for c in cells] == list(range(512))
    for a, b in zip(cells, cells[1:], strict=False):
        assert sum(abs(p - q) for p, q in zip(a[1:], b[1:], strict=True)) == 1


def test_octaves_are_in_order(spark):
    values = [0, 1, 2, 3, 4, 5, 6, 7, 8, 100, 1023, 1024, 2**33]
    frame = spark.createDataFrame([(v,) for v in values], "v long").select("v", octave_cell(F.col("v")).alias("c"))
    cells = [row.c for row in sorted(frame.collect())]
    assert cells == sorted(cells) and max(cells) < 256
    assert [v and 4 * (v.bit_length() - 1) + ((v << 2 >> (v.bit_length() - 1)) & 3) for v in values] == cells


def brute_cells(values, most=255):
    known = sorted({v for v in values if v is not None}, key=str.encode)
    place = {v: 1 + i * most // max(most, len(known)) for i, v in enumerate(known)}
    return [place.get(v, 0) for v in values]


@pytest.mark.parametrize("number, bits", [(1, 8), (20, 8), (255, 8), (256, 8), (1000, 8), (3, 1), (10, 2)])
def test_strings_by_rank(spark, number, bits):
    rng = random.Random(number)
    values = ["", "é" * 40, None] + ["prefix" * 9 + "".join(rng.choices("abcXYZ01", k=9)) for _ in range(number)]
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    cuts = string_cuts(frame, "value", bits)
    got = {r.value: r.cell for r in frame.select("value", string_cell(F.col("value"), cuts, bits).alias("cell")).collect()}
    assert got == dict(zip(values, brute_cells(values, (1 << bits) - 1), strict=True))
    assert max(got.values()) < 1 << bits


def test_a_null_leaves_the_other_cells_as_they_are(spark):
    sources = [f"src{i:02d}" for i in range(20)]
    for extra in ([], [None], [None, "", "zz-outlier"]):
        frame = spark.createDataFrame([(v,) for v in sources + extra], "value string")
        cell = string_cell(F.col("value"), string_cuts(frame, "value")).alias("cell")
        assert frame.where("value LIKE 'src%'").select(cell).distinct().count() == 20
        assert frame.select(cell).distinct().count() == 20 + len(extra)


def test_the_callers_columns_stay(spark):
    rows = [(i, f"s{i % 3}", "old", i) for i in range(30)]
    frame = spark.createDataFrame(rows, "id long, shard string, slot string, hilbert long")
    got = hilbert_shards(frame, ["shard"], ["hilbert"], ["id"], 4)
    assert {"shard_", "slot_", "hilbert_", "shard", "slot", "hilbert"} < set(got.columns)
    assert sorted((r.id, r.shard_, r.slot_, r.hilbert_) for r in got.collect()) == rows


def test_query_against_brute_force(answer, documents):
    rows = {}
    langs, sources = (brute_cells([d[c] for d in documents]) for c in ("lang", "source"))
    for d, lang, source in zip(documents, langs, sources, strict=True):
        data = (d.text or "").encode()
        size = len(data) + 16
        exponent = size.bit_length() - 1
        cell = min(255, 4 * exponent + (size << 2 >> exponent & 3))
        rows[d.doc_id] = (index((lang, source, cell), 8), d.doc_id, zlib.crc32(data), size)
    order = sorted(rows.values())
    total = len(order)
    want = {}
    for place, (_, doc_id, crc, size) in enumerate(order):
        shard = place * 40 // total
        want[doc_id] = (size, crc, "rows", shard, place - -(-shard * total // 40), None)
    got = {r.doc_id: (r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in answer("op5_hilbert_shards")}
    assert got == want
    counts = Counter(row[3] for row in got.values())
    assert len(counts) == 40 and max(counts.values()) - min(counts.values()) <= 1


def test_plan_has_no_python(spark, sf_dir):
    from lectern.llm.queries import QUERIES

    plan = QUERIES["op5_hilbert_shards"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_hot_nulls_and_files(spark, tmp_path):
    rows = [(i % 5 or None, None if i % 3 else "s", i % 2 and i, "x") for i in range(1000)]
    frame = spark.createDataFrame(rows, "id long, s string, n long, shard string")
    got = hilbert_shards(frame, ["s"], ["n"], ["id"], 7)
    assert sorted(Counter(r.shard for r in got.collect()).values()) == [142, 143, 143, 143, 143, 143, 143]
    write_shards(got, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1000 and len(back.inputFiles()) == 7


def test_empty(spark):
    frame = spark.createDataFrame([], "id long, s string, n long")
    assert hilbert_shards(frame, ["s"], ["n"], ["id"], 3).count() == 0
