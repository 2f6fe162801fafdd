"""Records of news against Python's csv module, wherever the scan cuts a file into blocks."""

import csv

import pytest

from barloom.sources import tables

ODD = ["Timestamp,URL,text", "2024-01-02,http://x,one, two, three", '2024-01-03,"http://y,z","said ""so"", twice', "", 'and ""more""",tail', '"a"b""c,u,"x"', '",",",\n",""']
MORE = ['2024,u,﻿"late, mark', "", ",,", '2024-01-04,u,5" wide', '"\n\n",v,"""\n"""', *(f'd{i},u,"{"line, " * (i % 7)}\nmore {i}"" of "" it\n"' for i in range(40))]
#: Too many commas for a pattern that takes a whole record in one match.
MANY = "2024,u,plain" + ", more" * 20_000


@pytest.mark.parametrize("split", ["500b", "4k", "128m"])
def test_records_over_the_blocks_of_a_file(spark, tmp_path, split):
    text = "﻿" + "\n".join([*ODD, *MORE, MANY, '2024,v,"never closed\nand, on'])
    (tmp_path / "T.csv").write_text(text, encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted(map(tuple, tables.read_news(spark, str(tmp_path), multiline=True).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    csv.field_size_limit(1 << 20)
    with open(tmp_path / "T.csv", encoding="utf-8-sig", newline="") as f:
        rows = [r for r in list(csv.reader(f))[1:] if any(c.strip(" ") for c in r)]
    assert got == sorted(("T", r[0].strip(" "), r[1].strip(" "), ",".join(r[2:]).strip(" ")) for r in rows)
