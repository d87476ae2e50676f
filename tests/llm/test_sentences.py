import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import sentences as S

CASES = [
    ["Dr. M. Votehamezu compared A vs. B for tagging.", "At 3 a.m. on day 2 it stopped."], ["See Fig. 3 and Sec. 5.8 for more, e.g. the list.", "It ended in 2014.", "It moved on, etc.", "(See Tab. 8 for the full list.)", "Then it grew."],
    ["“Is X clear enough?” asked the intern of Y Inc. in 2014.", "The card reads: “Do not use.”", "“Was it?” he asked."], ["It was modest... yet it won.", "It is gone...", "The end!", "Why?"], ["zomaku is a stable decoder.", "vikaro-1.6 beat it by 3.5 pts. under load."],
    ["Die 2. Fassung startete um 3 Uhr.", "Am 1. März 2017 kam z. B. Xaber mit 94,7 Mrd. Parametern, d. h. Yaver.", "„Reicht das?“, fragte Frau Dr. Z."], ["« Faut-il garder ? » demande M. X dans la note.", "Le gain (cf. sect. 9.3) reste p. ex. faible !"], ["«¿Basta con eso?», preguntó la Dra. X.", "¿Por qué falla?", "¡Qué salto!"],
    ["В 2021 г. группа взяла 23 узлов, в т. ч. для задачи.", "«Хватит ли?» — спросил рецензент.", "Проф. R. В назвал его."], ["डॉ. X के अनुसार त्रुटि घटी।", "“क्या यह पर्याप्त है?” समीक्षक ने पूछा।", "क्या यह स्थिर है?"], ["قارن أ. د. X بين الاثنين؛ ولم يحسم الأمر.", "هل يكفي؟", "يا لها من نتيجة!"],
]
GLUED = [
    ["“是否足够稳定？”审稿人这样问道。", "作者写道：“并不万能。”", "X的7.9版本（约21人）改善了任务。", "结果令人惊讶！"], ["「安定しているか。」と査読者は尋ねた。", "報告書には「万能ではない。確認せよ。」とある。", "驚くべき結果だ！"],
]


def texts(t):
    return [t[a - 1 : b] for a, b in S.split(t)]


@pytest.mark.parametrize("sentences", CASES)
def test_languages(sentences):
    assert texts(" ".join(sentences)) == sentences


@pytest.mark.parametrize("sentences", GLUED)
def test_scripts_without_spaces(sentences):
    assert texts("".join(sentences)) == sentences


def test_thai():
    s = ["ทีมวิจัยทดสอบการกลั่นความรู้ในปี 2015 แล้ว", "โมเดล Tozozemuje ใช้การกรองข้อมูล", "Read the abstract and list every model.", "ทำไมจึงไม่ช่วย"]
    assert texts(" ".join(s)) == s


def test_layout():
    t = "2. Results and Discussion\n\nOne line\nwrapped here. Die\n2. Fassung kam. Two.\n\n- item one. still one\n- item two\n  goes on\n\n1. A b.\n2. C d.\n\nModel Card: X\n\n \n"
    assert texts(t) == ["2. Results and Discussion", "One line\nwrapped here.", "Die\n2. Fassung kam.", "Two.", "- item one. still one", "- item two\n  goes on", "1. A b.", "2. C d.", "Model Card: X"]


def test_glued_and_urls():
    assert texts("It loses 3.5 points.Our next one at https://a.invalid/v3.1/weights, see it.A last") == ["It loses 3.5 points.", "Our next one at https://a.invalid/v3.1/weights, see it.", "A last"]


@pytest.mark.parametrize("t", ["", "   \n ", ".", "...", "“", "((((", ")", "a", "\n\n\n"])
def test_odd_texts(t):
    got = S.split(t)
    assert all(1 <= a <= b <= len(t) and not t[a - 1].isspace() and not t[b - 1].isspace() for a, b in got)


def test_unmatched_marks_swallow_nothing():
    assert texts("He (said so. She left. “They stay. It is over.") == ["He (said so.", "She left.", "“They stay.", "It is over."]


def test_scan_equals_sequential_run():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 5_000):
        sym = rng.integers(0, S.N_SYMBOLS, n)
        got = S.scan(sym, np.arange(S.N_STATES))
        for start in range(S.N_STATES):
            state = start
            for i in range(min(n, 300)):
                assert got[i, start] == state
                state = S.TO[sym[i], state]


def test_chunks_equal_whole_texts(spark):
    rng = random.Random(2)
    pool = [s for c in CASES for s in c] + ["\n\n", "\n\n- item. one\n- two\n\n", "\n\n7 Introduction\n\n"]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(k))) for i, k in enumerate([0, 1, 3, 40, 200, 900])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expected = {(i, a, b) for i, t in docs for a, b in S.split(t)}
    for chunk in (1_500, 4_000, 65_536):
        got = [tuple(r) for r in S.sentences(df, chunk=chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_long_document_twice(spark):
    quote = "“" + "They measured it again. " * 90 + "It held.” Then they left."
    df = spark.createDataFrame([(1, quote)] * 2 + [(2, "A b. C d.")] * 2, "doc_id long, text string")
    got = sorted(tuple(r) for r in S.sentences(df, chunk=500).collect())
    assert got == sorted([(1, a, b) for a, b in S.split(quote)] + [(2, 1, 4), (2, 6, 9)])
    assert sum(r[0] == 1 for r in got) == 2


def test_what_lies_far_ahead_or_behind(spark):
    inner = "It was measured once more. " * 80  # over 2,000 characters
    docs = [
        f"She said “{inner.strip()}” and left. He (so {inner.strip()}) stayed. End.", f"She said “{inner} and left.\n\nAn end” here. End.", f"Before (so {inner}\n\n) after. End.",
        "\n".join(f"{k}. {inner.strip()}" for k in range(1, 6)), "\n".join(f"{k}. {inner.strip()}" for k in (1, 3, 4, 7)), f"1. One\n{inner}\n\n2. Two\n{inner}\n3. Three",
        f"A b.{' ' * 3_000}C d.{chr(10) * 3_000}- e f{'.' * 3_000} G h{'!?' * 1_500} I j.", f"A b.{' ' * 700}{chr(10)}{' ' * 700}- C d. E f.{' ' * 900}G.",
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    expected = {(i, a, b) for i, t in enumerate(docs) for a, b in S.split(t)}
    for chunk in (64, 311, 1_000, 2_048):
        got = [tuple(r) for r in S.sentences(df, chunk=chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


@given(st.text(alphabet="aB1 .\n!?“”\"()«»-2)、。กx", max_size=400), st.integers(5, 60))
@settings(max_examples=300, deadline=None)
def test_chunks_of_any_text_equal_the_whole(text, chunk):
    """The chunk path in plain Python: functions of chunks composed, what lies ahead and behind handed on."""
    import pandas as pd

    pieces = pd.concat([*S._pieces(chunk, 48)(iter([pd.DataFrame({"doc_id": [1], "text": [text]})])), pd.DataFrame()])
    rows, beyond, before = pieces.to_dict("records"), "", []
    for r in reversed(rows):
        r["beyond"], beyond = beyond, r["closing"] + ("" if r["blank"] else beyond)
    for r in rows:
        r["before"], before = before, r["numbers"] if r["blank"] else [*before, *r["numbers"]]
    state, cuts = 0, []
    for r in rows:
        parts = next(S._chunk_parts(iter([pd.DataFrame([r])])))
        cuts += [int(c) for c, mask in zip(parts.cut, parts.fires) if mask > 0 and mask >> state & 1]
        state = parts.f[0][state]
    assert list(S.spans(text, sorted(cuts))) == S.split(text)


def test_nulls_repeats_clashes_and_empty(spark):
    df = spark.createDataFrame([(1, "A b. C d.", 5, "x"), (2, None, 5, "x"), (3, "", 5, "x"), (None, "E.", 5, "x"), (1, "A b. C d.", 5, "x")], "doc_id long, text string, start_pos int, chunk string")
    assert sorted((r.doc_id, r.start_pos, r.end_pos) for r in S.sentences(df).collect()) == [(1, 1, 4), (1, 6, 9)]
    assert S.sentences(df.limit(0)).count() == 0


def test_every_visible_character_is_in_one_sentence(spark, small):
    import pandas as pd

    for t in pd.read_parquet(f"{small}/documents.parquet").text:
        at = 0
        for a, b in S.split(t):
            assert not t[at : a - 1].strip() and a > at
            at = b
        assert not t[at:].strip()
