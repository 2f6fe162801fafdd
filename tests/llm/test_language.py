"""Language identification: held-out accuracy, plain sizes, and rows out of the ordinary."""

import random
import re
import unicodedata
import zlib

import pytest
import zstandard

from barloom.llm import language
from barloom.llm.entries import queries


@pytest.mark.parametrize(("sf", "least"), [("sf0.01", 0.98), ("sf0.1", 0.985)])
def test_held_out_accuracy(spark, sf, least):
    d = f"/root/testdata/{sf}"
    got = queries()["op12_language_id"](spark, d).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", "text").collect()}
    assert len(got) == len(docs) and {r.doc_id for r in got} == set(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    for r in got:
        has = any(unicodedata.category(c)[0] == "L" for c in docs[r.doc_id].text or "")
        assert (r.lang_pred == "und") == (not has)
    tried = [r for r in got if r.held_out and r.lang_pred != "und"]
    right = [r for r in tried if r.lang_pred == docs[r.doc_id].lang]
    assert len(right) >= least * len(tried)
    sure = [r for r in tried if not r.rejected]
    assert len(sure) >= 0.95 * len(tried)
    assert sum(r.lang_pred != docs[r.doc_id].lang for r in sure) <= (1 - least) * len(tried)


def corpus(seed, n=60):
    """Made-up languages with syllables of their own."""
    r = random.Random(seed)
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["szt", "rze", "owa", "cki"], "cc": ["ñan", "qué", "ío", "lla"]}
    return [(k, lang, " ".join("".join(r.choices(s, k=r.randrange(1, 4))) for _ in range(40))) for k in range(n) for lang, s in syllables.items()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def test_whole_text_is_encoded_chunk_by_chunk(spark):
    dictionaries = language.fit(frame(spark, corpus(1)), "text", "lang")
    assert sorted(k for k, _ in dictionaries) == ["aa", "bb", "cc"]
    of = language.Identifier(dictionaries)
    text = " ".join(t for _, lang, t in corpus(2, 400) if lang == "bb")
    found = []
    for name, content in dictionaries:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(5, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
        data = f" {text} ".encode()
        found.append(sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=how).compress(data[k : k + 512])) for k in range(0, len(data), 512)))
    # the same sizes but for what a digested dictionary costs
    assert [k for k, _ in dictionaries][found.index(min(found))] == of(text)[0] == "bb"
    assert all(abs(a - b) <= 0.05 * b for a, b in zip(of.sizes(f" {text} ".encode(), of.fast), found))


def test_rows_out_of_the_ordinary(spark):
    rows = corpus(1)
    dictionaries = language.fit(frame(spark, rows), "text", "lang")
    docs = [(1, None), (2, ""), (3, " 12 -- ٣ \n"), (4, "ka"), (5, "Lo, MI! TU-ka 77"), (5, "Lo, MI! TU-ka 77"), (None, "ñan qué ío lla"), (6, "szt owa " * 200_000), (7, "́"), (8, "字"), (9, "zzzz wwww xxxx")]
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in docs], "doc_id long, text string, lang_pred string, held long")
    got = language.identify(df, dictionaries).collect()
    assert df.columns == ["doc_id", "text", "lang_pred", "held"] and len(got) == len(docs)
    by = {(r.doc_id, r.text): (r.lang_pred, r.score, r.rejected) for r in got}
    assert all(by[x] == ("und", 0.0, True) for x in docs[:3]) and by[7, "́"][0] == "und"
    assert [by[x][0] for x in (docs[4], docs[6], docs[7])] == ["aa", "cc", "bb"] and not by[docs[7]][2]
    assert by[8, "字"][0] in ("aa", "bb", "cc") and by[8, "字"][2] and by[9, "zzzz wwww xxxx"][2]
    assert {r.held for r in got} == {3}


def test_nothing_to_learn_from(spark):
    df = frame(spark, [(1, None, "some text"), (2, "en", None), (3, "en", "123")])
    assert language.fit(df, "text", "lang") == []
    assert [r.lang_pred for r in language.identify(df, []).collect()] == ["und"] * 3
    assert language.identify(df.limit(0), []).collect() == []
    one = language.fit(frame(spark, [(1, "en", "just this")]), "text", "lang")
    assert [tuple(r) for r in language.identify(df.where("doc_id = 1"), one).select("lang_pred", "rejected").collect()] == [("en", False)]


def test_copies_and_rare_languages(spark):
    rows = corpus(3, 20) + [(k, "aa", "ka lo mi " * 30) for k in range(3000)] + [(9, "dd", "wyx uvw vux")]
    dictionaries = language.fit(frame(spark, rows), "text", "lang")
    assert [k for k, _ in dictionaries][0] == "aa" and {k for k, _ in dictionaries} == {"aa", "bb", "cc", "dd"}
    assert len(re.findall("ka lo mi ka lo mi ka", dict(dictionaries)["aa"].decode())) < 40
