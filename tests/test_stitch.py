"""Stitching against a plain list version, over files, splits and blocks."""

import random

import pytest

from sheaftext.operators.stitch import ROW, SOURCE, SPLIT, numbered_lines, stitch_lines


def by_hand(lines, min_fields):
    out, i = [], 0
    while i < len(lines):
        if len(lines[i].split(";")) < min_fields and i + 1 < len(lines):
            out.append(lines[i] + lines[i + 1])
            i += 2
        else:
            out.append(lines[i])
            i += 1
    return out


def random_lines(seed, n, short_share):
    draw = random.Random(seed)
    return [";".join(f"{i}.{k}" for k in range(draw.randint(1, 4) if draw.random() < short_share else draw.randint(5, 7))) for i in range(n)]


@pytest.mark.parametrize("short_share", [0.0, 0.3, 0.7, 0.97, 1.0])
@pytest.mark.parametrize("bits", [0, 2, 10])
def test_files_splits_and_blocks(spark, tmp_path, short_share, bits):
    expected = []
    for seed in range(3):
        lines = random_lines(seed, 120 + seed, short_share)
        (tmp_path / f"f{seed}.txt").write_text("\n".join(lines) + "\n")
        expected += by_hand(lines, 5)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        numbered = numbered_lines(spark, str(tmp_path))
        assert numbered.select(SPLIT).distinct().count() > 3
        got = [r.value for r in stitch_lines(numbered, block_bits=bits).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(expected)


def test_order_columns_come_back(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1;2\n3;4;5\nx;y;z;v;w\n")
    df = stitch_lines(numbered_lines(spark, str(tmp_path)))
    assert df.columns == [SOURCE, SPLIT, ROW, "value"]
    assert [r.value for r in df.orderBy(SPLIT, ROW).collect()] == ["1;23;4;5", "x;y;z;v;w"]


def test_other_width_and_delimiter(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a|\nb\nc|d\n")
    got = [r.value for r in stitch_lines(numbered_lines(spark, str(tmp_path)), delimiter="|", min_fields=3).collect()]
    assert sorted(got) == ["a|b", "c|d"]
