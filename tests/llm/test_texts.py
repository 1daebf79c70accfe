from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rovermill.llm import encoding
from rovermill.llm.encoding import Encoder, EncodingRules, encode_corpus, encoder
from rovermill.llm.packing import PackingRules, best_fit, pack
from rovermill.llm.sentences import sentences

ALPHABET = st.text(alphabet=st.one_of(st.sampled_from(list("aab  \n\t''sre.,;12é字かก้🤖 　‍")), st.characters(exclude_categories=("Cs",))), max_size=300)


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=5))
def test_chunked_ids_agree(texts):
    want = [encoder(None).encode_ordinary(t) for t in texts]
    for bits, kept in ((2, 10), (4, 10_000)):
        enc = Encoder(EncodingRules(window=3, mask_bits=bits, kept_chars=kept))
        assert list(enc.ids(texts)) == want
        # all again, from memory
        assert list(enc.ids(texts[::-1])) == want[::-1]


def test_slices_don_t_change_the_ids(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("ab cd. 12'字\n"), 700)) for _ in range(8)]
    want = [encoder(None).encode_ordinary(t) for t in texts]
    for size in (17, 64, 1000):
        monkeypatch.setattr(encoding, "SLICE", size)
        assert list(Encoder(EncodingRules(window=5, mask_bits=3)).ids(texts)) == want


def test_shared_chunks_are_encoded_once():
    """Documents that hold a long stretch in common at different places: its chunks are taken from memory."""
    rng = np.random.default_rng(3)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    shared = word(3000)
    texts = [word(20 + 7 * k) + " " + shared + " " + word(30) for k in range(10)]
    enc = Encoder(EncodingRules())
    assert list(enc.ids(texts)) == [encoder(None).encode_ordinary(t) for t in texts]
    assert enc.reused > 8 * enc.encoded / 3 and enc.encoded < 80


def test_corpus(spark):
    long = "The robot's motor isn't warm.  " * 4000 + "字" * 5000 + "\n\n" + " " * 700 + "'re"
    texts = [None, "", " ", long, long[7:], "<|endoftext|>", "a", "a"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, long, 1), (None, "x", 1)], "doc_id long, text string, row int")
    got = [(r.doc_id, r.ids) for r in encode_corpus(df).collect()]
    want = [(i, encoder(None).encode_ordinary(t or "")) for i, t in enumerate(texts)] + [(3, encoder(None).encode_ordinary(long)), (None, encoder(None).encode_ordinary("x"))]
    key = lambda x: (x[0] is None, x[0] or 0, len(x[1]))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert encode_corpus(df.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=200), st.integers(1, 6))
def test_best_fit(sizes, bins):
    place, at = best_fit(sizes, 50, bins)
    room: dict = {}
    for s, b, o in zip(sizes, place, at, strict=True):
        assert room.get(b, 0) == o
        room[b] = o + s
    assert all(v <= 50 for v in room.values())
    assert sum(room.values()) == sum(sizes)


def test_pack(spark):
    rng = np.random.default_rng(0)
    items = [(i, int(v)) for i, v in enumerate(rng.integers(0, 900, 3000))] + [(5000, 2048), (5001, 2049), (5002, 10_000), (5003, None), (5004, 0), (5000, 2048)]
    df = spark.createDataFrame(items, "doc_id long, n_tokens int")
    rows = pack(df, PackingRules(shard_bins=200)).collect()
    used: dict = {}
    for r in rows:
        used.setdefault(r.bin_id, []).append((r.bin_offset, r.part_tokens))
    for parts in used.values():
        end = 0
        for o, n in sorted(parts):
            assert o >= end
            end = o + n
        assert end <= 2048
    got: dict = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.part_start, r.part_tokens))
    assert sorted(got[5002]) == [(0, 2048), (2048, 2048), (4096, 2048), (6144, 2048), (8192, 1808)]
    assert sorted(got[5001]) == [(0, 2048), (2048, 1)] and got[5003] == got[5004] == [(0, 0)] and len(got[5000]) == 2
    assert all(len(got[i]) == 1 for i in range(3000))
    assert sum(n for v in got.values() for _, n in v) == sum(n or 0 for _, n in items)
    assert sum(n or 0 for _, n in items) / (2048 * len(used)) > 0.93
    assert pack(df.limit(0)).count() == 0


CASES = {
    "Dr. Orr drew 4.78 A in St. Orr Road. It stopped at 4 p.m. As of v2.5.12, all is well, e.g. when turning left!": ["Dr. Orr drew 4.78 A in St. Orr Road.", "It stopped at 4 p.m.", "As of v2.5.12, all is well, e.g. when turning left!"],
    "Cables, etc. were checked by J. R. Tosk at 5 a.m. sharp. See Sec. 3 and No. 4.": ["Cables, etc. were checked by J. R. Tosk at 5 a.m. sharp.", "See Sec. 3 and No. 4."],
    "“Bring it home. Leave it alone,” the pilot said. He typed “hold!” and left.": ["“Bring it home. Leave it alone,” the pilot said.", "He typed “hold!” and left."],
    "It drew 5 A. Was it late? rpm_3 fell. (It was replaced.) Done ... Next": ["It drew 5 A.", "Was it late?", "rpm_3 fell.", "(It was replaced.)", "Done ...", "Next"],
    "Title 5\n\n- one thing\n- another\n\n1. first\n2. second\n3. third\n\nText goes\non here. End": ["Title 5", "- one thing", "- another", "1. first", "2. second", "3. third", "Text goes\non here.", "End"],
    "[04:32:12] ops: All fine. Go!\r\n[04:32:19] bot: ok": ["[04:32:12] ops: All fine.", "Go!", "[04:32:19] bot: ok"],
    "Am 5. Testtag war Nr. 3, d. h. alles, z. B. das, zu warm! „Halt!“, rief Frau Orr. Um 5 Uhr": ["Am 5. Testtag war Nr. 3, d. h. alles, z. B. das, zu warm!", "„Halt!“, rief Frau Orr.", "Um 5 Uhr"],
    "« Arrête ! » a crié Mme Orr. Voir p. 5, c.-à-d. trop tard ! Où ?": ["« Arrête ! » a crié Mme Orr.", "Voir p. 5, c.-à-d. trop tard !", "Où ?"],
    "¿Por qué? ¡Tras 6,8 km, p. ej. al girar! La Sra. Orr esperó… y siguió.": ["¿Por qué?", "¡Tras 6,8 km, p. ej. al girar!", "La Sra. Orr esperó… y siguió."],
    "«Стой!» — крикнул оператор. Кабели и т. д. целы, см. рис. 2. Да": ["«Стой!» — крикнул оператор.", "Кабели и т. д. целы, см. рис. 2.", "Да"],
    "Ο κ. Orr έφτασε, π.χ. στη στροφή; Μετά τελείωσε.": ["Ο κ. Orr έφτασε, π.χ. στη στροφή;", "Μετά τελείωσε."],
    "他喊：“停下！不要动！”然后走了。误差8.02米！（见第5页。）好": ["他喊：“停下！不要动！”然后走了。", "误差8.02米！", "（见第5页。）", "好"],
    "「待って。すぐ行く。」と告げた。3番です！　次": ["「待って。すぐ行く。」と告げた。", "3番です！", "次"],
    "로봇이 “잠깐. 곧 가요.”라고 했다. 1.7 m입니다! 끝": ["로봇이 “잠깐. 곧 가요.”라고 했다.", "1.7 m입니다!", "끝"],
    "ล้อหยุดนิ่ง วันนี้แสดงค่า 3.4 เมตร อีกครั้ง": ["ล้อหยุดนิ่ง", "วันนี้แสดงค่า 3.4 เมตร", "อีกครั้ง"],
    "“रुको। हिलो मत।” उसने कहा। डॉ. Orr सं. 5 पर है।": ["“रुको। हिलो मत।” उसने कहा।", "डॉ. Orr सं. 5 पर है।"],
    "هل توقف؟ حسب د. Orr نعم. «قف!» ثم ترك.": ["هل توقف؟", "حسب د. Orr نعم.", "«قف!» ثم ترك."],
    "It held tyres, fuses, etc. rpm_1 fell, no. 85 etc. 3 km on, at 5 p.m. 12 left.": ["It held tyres, fuses, etc.", "rpm_1 fell, no. 85 etc.", "3 km on, at 5 p.m.", "12 left."],
    "👍🏽 ok? 🚧🚧! Then 5": ["👍🏽 ok? 🚧🚧!", "Then 5"],
}


def test_sentences(spark):
    texts = [*CASES, None, "", " \n　 ", "x" * 50_000 + ". Yes."]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, parts string")
    got: dict = {}
    for r in sentences(df).orderBy("doc_id", "sent_idx").collect():
        assert texts[r.doc_id][r.sent_start : r.sent_end] == r.sentence
        got.setdefault(r.doc_id, []).append(r.sentence)
    for i, (text, want) in enumerate(CASES.items()):
        assert got[i] == want, text
    n = len(CASES)
    assert n not in got and n + 1 not in got and n + 2 not in got
    assert [len(s) for s in got[n + 3]] == [50_001, 4]
    assert sentences(df.limit(0)).count() == 0


@pytest.mark.parametrize("form", ["NFC", "NFD"])
def test_both_normal_forms(spark, form):
    import unicodedata

    t = unicodedata.normalize(form, "C.-à-d. trop tard. Véase la pág. 5. Été là.")
    out = [r.sentence for r in sentences(spark.createDataFrame([(1, t)], "doc_id long, text string")).orderBy("sent_idx").collect()]
    assert [unicodedata.normalize("NFC", s) for s in out] == ["C.-à-d. trop tard.", "Véase la pág. 5.", "Été là."]


def test_long_quotations_and_list_items(spark):
    """Neither has a greatest length; a quotation that doesn't close before a blank line holds nothing."""
    long = "the rover went on and on past every post of the yard " * 40
    cases = {
        f"He said “{long}. It stopped. {long},” and left. Then rest.": [f"He said “{long}. It stopped. {long},” and left.", "Then rest."],
        f"1. {long}end\n2. {long}end\n3. third": [f"1. {long}end", f"2. {long}end", "3. third"],
        "He said “one. Two.\n\nThree. Four” five.": ["He said “one.", "Two.", "Three.", "Four” five."],
        "»Halt!«, rief sie. " + "Er ging. " * 60 + "Sie sah »B« an.": ["»Halt!«, rief sie.", *["Er ging."] * 60, "Sie sah »B« an."],
        "„Halt!“, rief sie. " + "Er ging. " * 60 + "Sie sah “B” an.": ["„Halt!“, rief sie.", *["Er ging."] * 60, "Sie sah “B” an."],
        "He said “" + "Go on. " * 20_000 + "now,” and left. Then rest.": ["He said “" + "Go on. " * 20_000 + "now,” and left.", "Then rest."],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got: dict = {}
    for r in sentences(df).orderBy("doc_id", "sent_idx").collect():
        got.setdefault(r.doc_id, []).append(r.sentence)
    for i, (text, want) in enumerate(cases.items()):
        assert got[i] == want, (i, [x[:80] for x in got[i]][:8])


def spans(spark, *texts):
    rows = sentences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    out = [[] for _ in texts]
    for r in sorted(rows, key=lambda r: (r.doc_id, r.sent_idx)):
        assert texts[r.doc_id][r.sent_start : r.sent_end] == r.sentence
        out[r.doc_id].append(r.sentence)
    return out


def test_texts_that_hold_the_marks(spark):
    marks = ["\ue000", "\ue001", "\ue002", "\ue003"]
    got = spans(spark, *[f"Go on. The icon {m} is here. End {m}{m} it now." for m in marks])
    assert got == [["Go on.", f"The icon {m} is here.", f"End {m}{m} it now."] for m in marks]


def test_long_quotations_and_lists(spark):
    quoted = "He said “" + "It is so. " * 500 + "yes” and left."
    items = [f"{k}. " + "a long way " * 200 for k in range(1, 4)]
    got = spans(spark, quoted + " Then more.", "\n\n" + "\n".join(items), "\n" + " " * 40 + "\n" + " " * 30 + "1. First")
    assert got[0] == [quoted, "Then more."]
    assert got[1] == [i.strip() for i in items] and got[2] == ["1. First"]


def test_further_scripts(spark):
    got = spans(spark, "Բարեւ։ Լավ։", "ሰላም። ደህና።", "မင်္ဂလာပါ။နေကောင်းလား။", "សួស្តី។ អ្នក។", "བཀྲ་ཤིས། བདེ་ལེགས།", "Πού; Εδώ " + "α" * 100 + "; Ναι.", "Il sig. Rossi arriva. Fine.")
    assert [len(g) for g in got] == [2, 2, 2, 2, 2, 3, 2]


def test_many_sentences_cost_in_proportion(spark):
    """Blocks of a fold: offsets and texts right across many of them."""
    n = 5_000
    got = spans(spark, "".join(f"Run {k} is over. " for k in range(n)))
    assert got[0] == [f"Run {k} is over." for k in range(n)]
