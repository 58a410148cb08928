import itertools
import random
import unicodedata

from pyspark.sql import functions as F

from heddle.functions import text as ft, web
from heddle.functions.composition import decomposed, nfc


def composed(spark, texts):
    # the column is the text's code points, as the source must not normalise it
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(nfc(F.col("t"))).collect()]


VIETNAMESE = [c for base in "aAăĂâÂeEêÊiIoOôÔơƠuUưƯyYdDđĐ" for c in [base, *(base + m for m in "̣̀́̃̉")]]


def test_all_vietnamese_letters_in_any_order_of_marks(spark):
    texts = []
    for c in VIETNAMESE:
        letter, *marks = unicodedata.normalize("NFD", c)
        texts += [letter + "".join(p) for p in itertools.permutations(marks)] + [unicodedata.normalize("NFC", c), unicodedata.normalize("NFC", letter + "".join(marks[:1])) + "".join(marks[1:])]
    assert composed(spark, texts) == [unicodedata.normalize("NFC", t) for t in texts]


def test_all_letters_with_one_and_two_marks(spark):
    letters = [chr(c) for c in (*range(0x20, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), 0x212A, 0x212B, 0x226E, 0x1F600, 0x4E00) if chr(c).isprintable() and not unicodedata.combining(chr(c))]
    marks = [chr(c) for c in range(0x300, 0x370)]
    chance = random.Random(1)
    texts = letters + [a + m for a in letters for m in chance.sample(marks, 12)] + [a + m for a in "aeiouAEIOUüûΑω" for m in marks]
    texts += [chance.choice(letters) + "".join(chance.choices(marks, k=k)) for k in (2, 3, 4) for _ in range(1500)]
    texts += ["".join(chance.choices(letters[:60] + marks[:20] + marks[35:60], k=30)) for _ in range(800)] + ["\u0323\u0301a", "\u0344", "x\u0344", "\u0340\u0341", "a\n\u0301", "", "\u034f\u0301a\u034f\u0301"]
    found = composed(spark, texts)
    wrong = [(t, f) for t, f in zip(texts, found) if f != unicodedata.normalize("NFC", t)]
    assert wrong == []


def test_null_and_texts_without_marks(spark):
    assert composed(spark, [None, "Căn hộ 850 nghìn", ""]) == [None, "Căn hộ 850 nghìn", ""]


def test_decomposed_text_has_prices_places_flags_and_phrases(spark):
    texts = ["850 nghìn", "Thành phố Thủ Đức", "có máy lạnh", "Tin đã hết hạn"]
    rows = spark.createDataFrame([tuple(unicodedata.normalize("NFD", t) for t in texts)], "price string, place string, story string, page string")
    back = rows.select(*(nfc(decomposed(F.lit(t))) for t in texts), *(decomposed(F.lit(t)) for t in texts)).first()
    assert list(back) == texts + [unicodedata.normalize("NFD", t) for t in texts]
    flags = {c: spark.createDataFrame([("có máy lạnh",)], "story string").select(*ft.amenity_flags(F.col("story"))).first()[c] for c in [f"has_{n}" for n in ft.vocab.AMENITIES]}
    found = rows.select(ft.parse_price(F.col("price")).alias("price"), ft.normalise_district(F.col("place")).alias("place"), *ft.amenity_flags(F.col("story")), web.classify_probe(F.lit(200), F.col("page"))[1].alias("reason")).first().asDict()
    assert found == {"price": 850_000, "place": "thu duc", "reason": "soft_delete"} | flags and any(flags.values())
