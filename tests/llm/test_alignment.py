"""Alignment against a plain version on whole texts, with the tokenizers' own libraries."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from stayflow.llm import alignment as al
from stayflow.llm.queries import TOKENIZER_A, TOKENIZER_B

FILES = al.Tokenizers.read(TOKENIZER_A, TOKENIZER_B)
TEXTS = [None, "", " ", "a", "plain words here", "  two  spaces ", "tab\tand\nline\r\n\n end", "naïve café — 東京 🙂🙂 ß", "it's <|endoftext|> </s> <unk> <0x41>",
         "x▁y", "▁", "word ▁ word", "a b\x1cc d", "nb space and　wide", "plain words here", "0123456789 " * 40, "z" * 3000,
         " " * 4000 + "end", "long text of words " * 30000, "\x00 ﻿ é"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(TOKENIZER_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZER_B)


def plain(text, libraries):
    """(n_a, n_b, groups as text, Counter of linked pairs) of a text."""
    a, b = libraries
    none = 0, 0, "", Counter()
    if not text:
        return none
    whole = b" " + text.encode()
    letters = al.byte_of_character()
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ta = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
    tb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
    if b"".join(ta) != whole or b"".join(tb) != whole:
        return none
    groups, links, i, j, ea, eb, ga, gb = [], Counter(), 0, 0, len(ta[0]), len(tb[0]), [ia[0]], [ib[0]]
    while True:
        links[ia[i], ib[j]] += 1
        if ea == eb:
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            i, j = i + 1, j + 1
            if i == len(ia):
                return len(ia), len(ib), ";".join(groups), links
            ea, eb, ga, gb = ea + len(ta[i]), eb + len(tb[j]), [ia[i]], [ib[j]]
        elif ea < eb:
            i += 1
            ea += len(ta[i])
            ga.append(ia[i])
        else:
            j += 1
            eb += len(tb[j])
            gb.append(ib[j])


def brute(texts, libraries):
    each = [plain(t, libraries) for t in texts]
    held = Counter(p for *_, links in each for p in links)
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    return [(na, nb, text.count(";") + 1 if text else 0, sum(links.values()), sum(n for p, n in links.items() if held[p] == most[p[0]]),
             sum(n * held[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else "") for na, nb, text, links in each]


@pytest.mark.parametrize("frequent, part", [(0, 1 << 10), (40, 1 << 14), (1 << 19, 1 << 20)])
def test_equal_to_a_plain_version(spark, libraries, frequent, part):
    docs = spark.createDataFrame([(k if k != 3 else None, t, "c", 1) for k, t in enumerate(TEXTS)], "doc_id long, text string, pair string, row int")
    got = al.align_documents(docs.repartition(3), FILES, frequent=frequent, part=part).collect()
    want = [(k if k != 3 else None, *r) for k, r in enumerate(brute(TEXTS, libraries))]
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r[c] for c in cols) for r in got], key=str) == sorted(want, key=str)


def test_documents_of_the_table(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in al.align_documents(docs, FILES).collect()}
    for r, want in zip(rows, brute([r["text"] for r in rows], libraries)):
        assert got[r["doc_id"]] == want


def test_empty_table(spark):
    assert al.align_documents(spark.createDataFrame([], "doc_id long, text string"), FILES).count() == 0


def test_a_small_memory_of_words_changes_nothing(monkeypatch):
    texts = ["some words and more words " * 9, "other words here", None, "some other words " * 500] * 3
    want = list(al.aligned_texts(texts, al.Words(al.encoder(FILES)), 1 << 20))
    monkeypatch.setattr(al, "CACHE_BYTES", 100)
    assert list(al.aligned_texts(texts, al.Words(al.encoder(FILES)), 64)) == want


def test_pointer_jumping_labels():
    a, b = np.array([3, 5, 9, 10, 14]), np.array([1, 5, 7, 12, 14])
    ga, gb = al.component_labels(a, b)
    assert ga.tolist() == [0, 0, 1, 1, 1] and gb.tolist() == [0, 0, 1, 1, 1]


def test_group_spans(spark, libraries):
    docs = spark.createDataFrame([(1, "naïve café it's"), (2, None), (3, "x▁y")], "doc_id long, text string")
    rows = sorted(al.group_spans(docs, FILES).collect(), key=lambda r: r["group"])
    assert {r["doc_id"] for r in rows} == {1}
    text = ";".join(",".join(map(str, r["a_ids"])) + "|" + ",".join(map(str, r["b_ids"])) for r in rows)
    assert text == plain("naïve café it's", libraries)[2]
    assert [r["start"] for r in rows] == [0, *[r["end"] for r in rows][:-1]] and rows[-1]["end"] == len(" naïve café it's".encode())
