"""Texts that were read in a wrong code page."""

import pytest
from pyspark.sql import functions as F

from opinionlens.functions import codepages

TEXTS = ["Привет, мир", "naïve café – “quoted” €5", "Ελληνικά γράμματα", "łódź żółć", "日本語のテキスト", "emoji 😀 ok", "ñandú à la carte"]


def fixed(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(2)
    return [r[1] for r in sorted(df.select("i", codepages.undo_misreading("s", **options)).collect())]


@pytest.mark.parametrize("page", codepages.PAGES)
def test_each_page(spark, page):
    def damaged(text):
        letters = codepages.page_letters(page)
        return "".join(chr(b) if b < 128 else letters[b - 128] for b in text.encode())

    once = [damaged(t) for t in TEXTS]
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, s string")
    assert [r[1] for r in sorted(df.select("i", codepages.misread("s", page)).collect())] == once
    assert fixed(spark, once) == TEXTS
    assert fixed(spark, [damaged(t) for t in once]) == TEXTS


@pytest.mark.parametrize(
    "damaged, text",
    [
        ("РџСЂРёРІРµС‚", "Привет"), ("cafÃ©", "café"), ("cafÃƒÂ©", "café"), ("Å‚Ã³dÅº", "łódź"), ("donâ€™t", "don’t"), ("caf√©", "café"), ("caf├⌐", "café"), ("Ă©tĂ©", "été"),
    ],
)
def test_literal_rows(spark, damaged, text):
    assert fixed(spark, [damaged]) == [text]


def test_sound_texts_stay(spark, sf_dir):
    sound = [*TEXTS, None, "", "ÀÉÎ", "Ñoño", "Übergröße", "«Ça va?»", "Привет, Ёж", "a´b", "10 °C – ½", "ﬁn…"]
    assert fixed(spark, sound) == sound
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    assert docs.filter(~F.equal_null("text", codepages.undo_misreading("text"))).count() == 0
