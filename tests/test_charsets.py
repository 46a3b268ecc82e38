"""Charsets learnt from some texts, found in others."""

from pyspark.sql import functions as F

from adgleaner.functions import charsets, web
from checks.queries import in_alphabet
from tests.conftest import DATA


def _texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null")
    return docs.select("doc_id", in_alphabet(F.col("text"), F.col("doc_id")).alias("text"))


def test_charsets_of_texts_not_learnt_from(spark):
    texts = _texts(spark)
    model = charsets.learn(texts.where("doc_id % 16 >= 8"))
    right = total = 0
    for r in texts.where("doc_id % 16 < 8").collect():
        for c in charsets.CHARSETS:
            try:
                b = r.text.encode(c)
            except UnicodeEncodeError:
                continue
            if len(b) > 200 and max(b) > 127:
                total += 1
                right += b.decode(model.best(b)) == r.text
    assert total > 50 and right >= 0.98 * total


def test_only_undeclared_pages_are_guessed(spark):
    model = charsets.learn(_texts(spark))
    russian = "абцдефгх ийклмноп ярстужвьыз " * 10
    pages = [
        (1, russian.encode("koi8-r"), russian),
        (2, russian.encode("utf-8"), russian),
        (3, b"<meta charset=iso-8859-1>\xe9", "<meta charset=iso-8859-1>é"),
        (4, b"<meta charset=nonsense>\xe9", "<meta charset=nonsense>é"),
        (5, ("<meta charset=windows-1251>" + russian).encode("windows-1251"), "<meta charset=windows-1251>" + russian),
        (6, "é".encode("utf-16"), "﻿é"),
        (7, b"", ""),
        (8, None, None),
    ]
    df = spark.createDataFrame([p[:2] for p in pages], "id int, b binary")
    got = {r.id: r.t for r in df.select("id", web.decode_page(F.col("b"), model).alias("t")).collect()}
    assert {k: v and v.lstrip("﻿") for k, v in got.items()} == {i: t and t.lstrip("﻿") for i, _, t in pages}


def test_no_texts_to_learn_from(spark):
    model = charsets.learn(_texts(spark).limit(0))
    assert model.best(b"caf\xe9") == "windows-1252" and model.best(b"") == "windows-1252"
    assert model.best(b"\x81\xe9") == "ibm850"  # no letter of windows-1252
