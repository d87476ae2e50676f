"""Cases that caps and blind spots used to lose."""

import pytest

from recordloom.llm import leakage as L


def found(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs, 1)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in L.leaks(d, spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_best_pair_among_many_passages():
    own = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    import numpy as np

    typed = L.Typed(frozenset())
    gap = ["zz"] * (L.DOC_GAP * 6)
    doc = []
    for k in range(12):  # parts of the first third, each a little else, and one smaller passage of the end
        doc += own[k % 6 : 20 + k % 3] + gap
    doc += own[48:58]
    sizes = np.array([len(w) for w in own])
    got = L.share_held(typed(" ".join(own)), sizes, typed(" ".join(doc)), list(range(len(doc))), renamed=False)
    assert got == pytest.approx((20 + 10) / 60)


def test_copies_and_shared_rare_words(spark):
    text = "The lab Vokabira lends seven schedulers to Tumodega for slot filling in the spring"
    assert found(spark, [f"x y z {text} a b c"], [(k, text) for k in range(1, 5)]) == {(1, k) for k in range(1, 5)}
    near = [(k, text + " " + "again " * k) for k in range(1, 5)]
    assert found(spark, [text], near) == {(1, k) for k, _ in near}
    assert found(spark, ["nothing of it is here, only the lab and the spring"], near) == set()


def test_short_items(spark):
    items = [(1, "Who owns Vokabira?"), (2, "short"), (3, "")]
    assert found(spark, ["They ask: who owns vokabira? Nobody.", "owns Vokabira who", "too short", ""], items) == {(1, 1), (3, 2)}


@pytest.mark.parametrize("text", [
    "The lab Vokabira lends seven schedulers to Tumodega in the spring", "Das Labor Vokabira verleiht sieben Planer an Tumodega im Frühling", "Le laboratoire Vokabira prête sept ordonnanceurs à Tumodega au printemps",
    "El laboratorio Vokabira presta siete planificadores a Tumodega en primavera", "第二轮里Nolonuleso回答了四十三题，其中七题答错，在五十四个节点上。",
    "Лаборатория Вокабира передаёт семь планировщиков компании Тумодега для проверки весной", "المختبر فوكابيرا يعير سبعة برامج إلى شركة تومودغا في الربيع القادم",
    "प्रयोगशाला वोकाबिरा सात अनुसूचक तुमोदेगा को वसंत में उधार देती है", "ห้องทดลองโวกาบิราให้ยืมตัวจัดตารางเจ็ดตัวแก่ทูโมเดกา", "ヴォカビラけんきゅうじょはスケジューラをトゥモデガにかします", "Το εργαστήριο Βοκαμπίρα δανείζει επτά προγράμματα στην Τουμοντέγκα",
])
def test_every_script(spark, text):
    assert found(spark, [f"Before. {text}. After.", text.upper(), "Before. After.", text[: len(text) // 5]], [(1, text)]) == {(1, 1), (2, 1)}
