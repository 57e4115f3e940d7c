"""Language ID against plain Python: the sample, the dictionaries, sizes, ties."""

import random

import pytest
import xxhash
import zstandard

from stayflow.llm import langid

SCHEMA = "doc_id long, text string, lang string, _lang string, _h string"


def hashed(text):
    """Spark's xxhash64 of a string."""
    n = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return n - (1 << 64) if n >> 63 else n


def corpus():
    rnd = random.Random(4)
    letters = {"aa": "abcdefgh", "bb": "mnopqrst", "cc": "uvwxyzéö"}
    rows = []
    for i in range(400):
        lang = ["aa", "aa", "aa", "bb", "cc", None][i % 6]
        text = " ".join("".join(rnd.choice(letters[lang or "aa"]) for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(1, 9)))
        rows.append((i, text if i % 17 else rows[i - 12][1] if i else "ABC abc", lang))
    rows += [(1000 + i, "the same text in a third of all rows", "aa") for i in range(200)]
    return [*rows, (2000, None, "aa"), (2001, "123 !!", "bb"), (2002, "", "cc")]


@pytest.mark.parametrize("salts", [1, 64])
def test_dictionaries_are_the_texts_with_the_smallest_hashes(spark, monkeypatch, salts):
    monkeypatch.setattr(langid, "SALTS", salts)
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(7)
    want = {}
    for lang in ("aa", "bb", "cc"):
        texts = {t for _, t, k in rows if k == lang and t and any(map(str.isalpha, t))}
        want[lang] = b"".join(langid.folded(t) + b"\n" for t in sorted(texts, key=hashed)[:30])
    assert langid.learn_dictionaries(df, sample_docs=30, dict_bytes=1 << 16) == want


def test_predictions_are_the_smallest_compression(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", "y") for r in [*rows, (3000, " ".join(r[1] for r in rows[:300]) * 40, None)]], SCHEMA).repartition(5)
    dictionaries = langid.learn_dictionaries(df, sample_docs=30, dict_bytes=1 << 16)
    dictionaries["zz"] = dictionaries["bb"]  # ties with bb

    def plain(text):
        if text is None or not any(map(str.isalpha, text)):
            return "und", None
        data, sizes = langid.folded(text), {}
        for k, d in dictionaries.items():
            c = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(
                d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[k] = sum(len(c.compress(data[i:i + langid.SEGMENT])) for i in range(0, len(data), langid.SEGMENT))
        least, second = sorted(sizes.values())[:2]
        return min(k for k in sizes if sizes[k] == least), (second - least) / second

    got = langid.identify(df, dictionaries).collect()
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    assert len(got) == len(texts)
    for r in got:
        lang, margin = plain(texts[r["doc_id"]])
        assert r["lang_pred"] == lang != "zz"
        if margin is not None:
            assert r["margin"] == pytest.approx(margin) and 0.5 <= r["score"] <= 1
            assert r["rejected"] == (margin < langid.MARGIN)
