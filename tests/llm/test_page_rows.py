"""What pages carry through a shuffle: compressed lines and hashes as bytes, and the lines come back as they were."""

import random
import zlib

import pytest

from wattloom.llm import pagediff


@pytest.mark.parametrize("lines", [[], [("a", True)], [("1", False), ("0 x", True), ("ä 　b", False)], [("", True), ("x", False)]])
def test_lines_come_back(lines):
    assert pagediff.split_lines(pagediff.joined_lines(lines)) == lines


def test_lines_are_compressed_before_the_shuffle(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["river", "stone", "mountain", "yellow", "harbour"]) for _ in range(400)) for _ in range(20)]
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<html><body><article><p>{t}</p></article></body></html>") for i, t in enumerate(texts)], "page_id bigint, url string, html string")
    rows = pagediff.parsed(pages).selectExpr("*", "page_id AS row")
    assert pagediff.packed(rows).selectExpr("sum(octet_length(lines)) AS n").first().n < sum(map(len, texts)) / 2
    assert {x.row: len(x.hashes) for x in pagediff.line_hashes(rows).collect()} == {i: 8 for i in range(20)}
    assert sorted((x.page_id, zlib.crc32(x.text.encode())) for x in pagediff.main_text(pages).collect()) == [(i, zlib.crc32(t.encode())) for i, t in enumerate(texts)]
