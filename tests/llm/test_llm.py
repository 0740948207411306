import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardmill.llm import leaks, mixture, pieces, pii, pii_model, sentences, term_counts
from wardmill.llm import tokenizers as tk

# ---- term counts


def test_counts_equal_brute_force(spark):
    r = random.Random(1)
    rows = [(i, [r.choice(["The", " the ", "a", "b%d" % r.randint(0, 40), "", None]) for _ in range(r.randint(0, 6))]) for i in range(300)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (1000, None), (None, ["the"])]
    df = spark.createDataFrame(rows, "term_id long, tokens array<string>").withColumn("token", F.lit("clash"))
    want: dict[str, list[int]] = {}
    for _, tokens in {str(k): (k, t) for k, t in rows}.values():
        clean = [t.strip().lower() for t in tokens or [] if t and t.strip()]
        for t in clean:
            want.setdefault(t, [0, 0])[0] += 1
        for t in set(clean):
            want[t][1] += 1
    got = {x.token: [x.occurrences, x.records] for x in term_counts.term_counts(df).collect()}
    assert got == want
    marked = term_counts.marked(df).collect()
    n = sum(any(t and t.strip() for t in tk_ or []) for _, tk_ in {str(k): (k, t) for k, t in rows}.values())
    assert all(x.n_records == n and x.too_rare == (x.records <= 2) and x.too_common == (x.records > 0.02 * n) for x in marked)
    assert len({x.token_id for x in term_counts.term_counts(df).collect()}) == len(want)
    assert term_counts.found(df.limit(0)).count() == 0


# ---- leaks


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=25))
def test_myers_equals_dynamic_programming(p, t):
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[-1] + 1))
        row, best = new, min(best, new[-1])
    assert leaks.myers(list(p), list(t), len(p)) == best


def test_latin_passages_of_chinese_items_are_found():
    drug = "methylprednisolone125mgq6h"
    items = [(1, "每日静脉注射药物如下" + drug + "持续三天后减量观察", "zh"), (2, "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏", "zh")]
    for budget in (0, 1):
        index = leaks.Index(items, budget)
        assert set(index.hits(f"given {drug} since")) == {1} and not index.hits("given prednisone 5 mg")
        assert not index.telling and leaks.Index(items[1:], budget).telling


def test_leaks_equal_brute_force(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(30)), "en") for i in range(8)] + [(50, "".join(r.choice("天地玄黄宇宙洪荒日月盈昃辰宿列张") for _ in range(60)), "zh"), (51, None, "en"), (52, "too short", None), (0, "", "en")]
    docs = []
    for i in range(60):
        words = [r.choice(vocabulary) for _ in range(20)]
        text = items[i % 9][1]
        n = r.randint(8, 24)
        if i % 9 == 8:
            text = "x " + text[5 : 5 + n] + "。y"
        else:
            q = text.split()
            at = r.randint(0, 30 - n)
            part = q[at : at + n]
            if i % 2:
                part[len(part) // 2] = "edited"
            text = " ".join(words) + "\n" + ", ".join(part).upper() + " ".join(["", *words])
        docs.append((i, text))
    docs += [(900, None), (901, ""), (902, docs[0][1])]
    grams = {}
    for k, t, lang in items:
        w = leaks._WORD.findall((t or "").casefold())
        u, size = ("".join(w), 20) if lang == "zh" else (w, 12)
        for j in range(len(u) - size + 1):
            grams.setdefault(tuple(u[j : j + size]), set()).add(k)
    want = set()
    for d, t in docs:
        w = leaks._WORD.findall((t or "").casefold())
        for u, size in ((w, 12), ("".join(w), 20)):
            for j in range(len(u) - size + 1):
                want |= {(d, k) for k in grams.get(tuple(u[j : j + size]), ())}
    dd = spark.createDataFrame(docs, "doc_id long, text string").withColumn("lang", F.lit("clash"))
    ii = spark.createDataFrame(items, "item_id long, text string, lang string")
    assert {(x.doc_id, x.item_id) for x in leaks.found(dd, ii).collect()} == want
    near = {(x.doc_id, x.item_id): x.distance for x in leaks.find_leaks(dd, ii).collect()}
    assert all(near[k] == 0 for k in want) and 1 in near.values()
    assert leaks.found(dd, ii.limit(0)).count() == 0 and leaks.found(dd.limit(0), ii).count() == 0


def _stretch_distance(p, t):
    """The least edit distance of p to any stretch of t, by dynamic programming."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[-1] + 1))
        row, best = new, min(best, new[-1])
    return best


@pytest.mark.parametrize("budget", [1, 2])
def test_near_passages_equal_brute_force(budget):
    """Every window within the budget is found, with its least distance: edits by change, drop and insertion, at any place."""
    r = random.Random(40 + budget)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(12, 26))), "en") for i in range(6)]
    index, hit, near = leaks.Index(items, budget), 0, 0
    for _ in range(150):
        words = r.choice(items)[1].split()
        at = r.randint(0, len(words) - 12)
        part = words[at : at + r.randint(11, 14)]
        for _ in range(r.randint(0, budget + 1)):
            k = r.randrange(len(part))
            kind = r.randint(0, 2)
            part = part[:k] + (["zz"] if kind < 2 else []) + part[k + (kind != 1) :]
        text = [r.choice(vocabulary) for _ in range(5)] + part + [r.choice(vocabulary) for _ in range(5)]
        got = {k: d for k, (d, _, _) in index.hits(" ".join(text)).items()}
        want = {}
        for k, t, _ in items:
            seq = t.split()
            d = min((_stretch_distance(seq[s : s + 12], text) for s in range(len(seq) - 11)), default=99)
            if d <= budget:
                want[k] = d
        assert got == want
        hit, near = hit + len(want), near + sum(d > 0 for d in want.values())
    assert hit > 80 and near > 30


# ---- sentences


@pytest.mark.parametrize(
    "units",
    [
        ["Dr. Smith came at 4 p.m. on Oct. 3.", "He left."],
        ["Sat. was 49 % on room air, vs. 54 % before.", "No. 7 etc. was closed.", "Pain since 1.5 h."],
        ['The patient said: "It is fine. I can walk."', "Gait is steady."],
        ['"I can\'t sleep." he told the nurse.', "Why?", "Stop it at once!"],
        ["(The knee was not examined.)", "Two views were taken."],
        ["Am 3. März wurde Dr. med. Klein gerufen.", "Er sagte: „Es tut weh.“", "Es bestehen z. B. Schwindel usw."],
        ["Elle a dit : « Ça va mieux. »", "Le Dr Roux a vu M. Petit."],
        ["¿Tiene fiebre?", "Dijo: «No puedo dormir.»", "El Sr. Paz mejora."],
    ],
)
def test_sentences_of_a_line(units):
    text = " ".join(units)
    corpus = sentences.Corpus(frozenset("Dr Oct Sat vs No med M Sr z Le".split()), frozenset(["p.m", "etc", "h"]), frozenset(["He", "The", "Why", "Two"]))
    assert [text[a:b] for a, b in sentences.split(text, corpus)] == units


def test_sentences_without_spaces():
    for units in (["体重1.52公斤。", "他说：“好。真的。”，然后走了。", "为什么?", "停！"], ["「待って。まだです。」と言った。", "少し待って……同意した。"]):
        assert [u for u in units] == ["".join(units)[a:b] for a, b in sentences.split("".join(units))]
    th = "ไม่มีไข้ เดินได้ดี 5 วัน แล้ว"
    assert [th[a:b] for a, b in sentences.split(th)] == ["ไม่มีไข้", "เดินได้ดี 5 วัน", "แล้ว"]
    hi = "वज़न 14.9 कि.ग्रा. है। क्या हुआ?"
    assert [hi[a:b] for a, b in sentences.split(hi)] == ["वज़न 14.9 कि.ग्रा. है।", "क्या हुआ?"]


def test_layout():
    text = "PLAN\nHe takes\nit daily. Stop.\n\n1. Stop it\n2. Go. Now\nBP: 120/80\nTemp.: 36.8 C\nSocial History:\nNever smoked."
    assert [text[a:b] for a, b in sentences.split(text)] == ["PLAN", "He takes\nit daily.", "Stop.", "1. Stop it", "2. Go. Now", "BP: 120/80", "Temp.: 36.8 C", "Social History:", "Never smoked."]


@settings(max_examples=300, deadline=None)
@given(st.text("aB. ?!\n\"“”「」。:1-(）,สइ", max_size=60))
def test_units_are_trimmed_ordered_and_whole(text):
    spans = sentences.split(text)
    assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    inside = {i for a, b in spans for i in range(a, b)}
    assert all(c.isspace() or i in inside for i, c in enumerate(text))


def test_what_each_evidence_decides(spark):
    """The corpus tells abbreviations from words that end sentences, the document settles what the corpus doesn't know; no list is there to ask."""
    names = "Kandel Morow Tirren Sallow Quint Barden Olsker Fenwick Hollis Trask".split()
    corpus = [(i, f"Seen by Dr. {n} at 4 p.m. on call. Was it late? The ward was full. He slept at 9 p.m. The end! He rose. Since approx. {i} days. Went home at 5 p.m. He left.") for i, n in enumerate(names * 3)]
    own = [(900, "The zorp. of water is low, but zorp. Kandel was seen. It rained."), (901, "Brought by the zorp. Kandel fell.")]
    df = spark.createDataFrame(corpus + own, "doc_id long, text string")
    said = {r.word: r.kind for r in sentences.evidence(df).collect()}
    assert said["Dr"] == "never" and said["approx"] == "never" and said["p.m"] == "abbreviation" and said["the"] == said["he"] == "starter" and "full" not in said
    want = {0: 9, 900: 2, 901: 2}
    for most in (sentences.MOST_WORDS, 0):  # sent to the tasks, and joined
        got = {r.doc_id: r["count"] for r in sentences.sentences(df, most_words=most).groupBy("doc_id").count().collect()}
        assert {k: got[k] for k in want} == want
    text = corpus[0][1]
    assert len(sentences.split(text)) > 9  # without the corpus
    ruled = sentences.Corpus(starters=frozenset(["the"]))
    assert len(sentences.split(own[0][1], ruled)) == 2 and len(sentences.split(own[1][1], ruled)) == 2


def test_sentences_frame(spark):
    df = spark.createDataFrame([(1, "Ab cd. Ef gh."), (2, None), (3, ""), (4, " \n"), (5, "x" * 50_000)], "doc_id long, text string").withColumn("sentence", F.lit("clash"))
    rows = sentences.sentences(df).orderBy("doc_id", "sent_no").collect()
    assert [(r.doc_id, r.sent_begin, r.sent_end) for r in rows] == [(1, 0, 6), (1, 7, 13), (5, 0, 50_000)]
    assert sentences.found(df.limit(0)).count() == 0


# ---- personal information


#: Carriers of another hand than those of the training grammar.
OTHER_RULES = """
holding: The {any}-{any} visit went well for Mr. {family} and his son {given} | Could you forward this to {name}, who waits at {address}, before Monday? | She left her number, {phone}, with the porter | Kindly use {email} from now on, wrote Mrs {family} | According to the card, MRN {chart}, she was born on {dob} | File under SSN: {ssn} for {comma} | Dr. {name} thinks that Ms. {family} may go home | We tried {phone} and {phone} without luck | Her brother {given} picked her up; he lives at {address} | Policy {policy} covers the {test} of Mr. {name} | Our records show DOB: {dob}, nothing else | Please ask Nurse {family} to mail {email}
plain: The {test} was repeated without any change | He felt {sym} while climbing {n2} steps | Order {x8} is still open | {Drug} {dose} seems to help | BP {n3}/{n2} after the walk | Nobody saw the {eponym} sign | They discussed {ill} at length
"""


def test_accuracy_on_a_grammar_of_another_hand():
    """Not sampled from the grammar that trained the model: what it says of other texts."""
    from wardmill.llm.pii_corpus import Maker

    for rules, least in ((None, 0.98), (OTHER_RULES.replace("The {any}-{any} visit", "The visit"), 0.9)):
        maker = Maker(987_654_321, rules)
        made = [maker.text() for _ in range(600)]
        got = pii_model.decode(pii_model.load(), [t for t, _ in made])
        want = {(i, *s) for i, (_, spans) in enumerate(made) for s in spans}
        have = {(i, *s) for i, spans in enumerate(got) for s in spans}
        print(len(want & have) / len(want), len(want & have) / len(have))
        assert len(want & have) / len(want) > least and len(want & have) / len(have) > least


def test_packed_lstm_equals_the_plain_one():
    p, r = pii_model.load(), np.random.default_rng(5)
    codes = [r.integers(1, pii_model.CHARS, n).astype(np.int16) for n in (40, 17, 17, 3, 1)]
    e, _ = pii_model.emissions(p, codes)
    H = p["Uf"].shape[0]
    for j, c in enumerate(codes):
        f = pii_model.lstm(c[:, None], p["E"] @ p["Wf"] + p["bf"], p["Uf"])[:, 0]
        b = pii_model.lstm(np.concatenate([[0, 0], c[::-1]]).astype(np.int16)[:, None], p["E"] @ p["Wb"] + p["bb"], p["Ub"])[2:, 0][::-1]
        want = f @ p["out"][:H] + b @ p["out"][H:] + p["bo"]
        assert np.abs(e[: len(c), :, j] - want).max() < 1e-3 and (e[len(c) :, 0, j] == 0).all()


def test_viterbi_equals_all_paths():
    import itertools

    p, r = pii_model.load(), np.random.default_rng(6)
    T = np.where(pii_model.allowed(), p["T"], -1e9)
    e = r.normal(0, 3, (4, pii_model.K, 6)).astype(np.float32)
    tags = pii_model.viterbi(p, e)
    for j in range(6):
        best = max((sum(e[t, x, j] for t, x in enumerate(path)) + sum(T[a, b] for a, b in zip(path, path[1:])) + (-1e9 if path[0] and path[0] % 2 == 0 else 0), path) for path in itertools.product(range(pii_model.K), repeat=4))[1]
        assert tuple(tags[:, j]) == best


def test_long_text_equals_windows():
    model = pii_model.load()
    part = "Call Rillis Kuzoxer on 247 555 0125 to confirm the echo. No dizziness today. "
    spans = pii_model.decode(model, [part * 40])[0]
    assert len(spans) == 80 and {(a % len(part), k) for a, _, k in spans} == {(a, k) for a, _, k in pii_model.decode(model, [part])[0]}
    assert pii_model.decode(model, ["", " ", "\n"]) == [[], [], []]


def test_days():
    for text, day in [("04/20/1995", "1995-04-20"), ("10.12.1927", "1927-12-10"), ("23-AUG-1943", "1943-08-23"), ("20090501", "2009-05-01"), ("April 9, 1950", "1950-04-09"), ("2 Jun 1999", "1999-06-02"), ("1999-06-02", "1999-06-02"), ("", None), (None, None), ("13/13/1999", None)]:
        assert pii.day_of(text) == day


def test_redaction(spark):
    rows = [(1, "t", "Mail it to 12 Foobrook Blvd., Apt 3. I spoke with Mr. Jon Kuzoxer.", 1), (1, "t", "Mail it to 12 Foobrook Blvd., Apt 3. I spoke with Mr. Jon Kuzoxer.", 2), (2, "t", None, 1), (3, "t", "", 1), (4, "t", "On 8/1/2019 we met the patient (09.10.1949) again.", 1), (5, None, "On 8/1/2019 we met the patient (09.10.1949) again.", 1)]
    sections = spark.createDataFrame(rows, "section_id long, tid string, text string, received_at int").withColumn("kind", F.lit("clash"))
    responses = spark.createDataFrame([("t", "10/09/1949"), ("t", "10/09/1949"), ("t", ""), ("t", None), (None, "8/1/2019")], "tid string, dob string")
    out = {r.section_id: r.text for r in pii.redact(sections, responses).collect()}
    assert out[1] == "Mail it to [ADDRESS]. I spoke with Mr. [NAME]." and out[2] is None and out[3] == ""
    assert out[4] == "On 8/1/2019 we met the patient ([DOB]) again." and out[5] == rows[5][2]
    assert pii.found(sections.limit(0), responses).count() == 0 and pii.found(sections, responses.limit(0)).filter("kind = 'dob'").count() == 0


# ---- mixtures


def test_allocation():
    take = mixture.allocate({"a": 100, "b": 10, "c": 0}, {"a": 0.5, "b": 0.4, "c": 0.1}, {"a": 2, "b": 3, "c": 9}, 110)
    assert take == {"a": 80.0, "b": 30.0, "c": 0.0}
    assert mixture.allocate({}, {"a": 1.0}, {"a": 1}, 5) == {"a": 0.0}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=200), st.floats(0.05, 0.95), st.integers(0, 99))
def test_cube_keeps_totals(sizes, p, seed):
    x = np.array(sizes, float)
    q = mixture.flight(np.full(len(x), p), x, np.random.default_rng(seed))
    assert abs((q * x).sum() - p * x.sum()) < 1e-6 * max(1, x.sum()) and abs(q.sum() - p * len(x)) < 1e-6 * len(x)
    assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= mixture.RESERVE + 2
    assert set(mixture.land(q, x)) <= {0.0, 1.0}


def test_mix(spark):
    r = random.Random(8)
    rows = [(i, "ab"[i % 3 == 0], "word " * r.randint(1, 60)) for i in range(600)] + [(9000, "tiny", "one two"), (9001, None, "x"), (9002, "other", "x y"), (9003, "a", None), (9004, "a", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("copies", F.lit("clash"))
    w = spark.createDataFrame([("a", 0.6, 2), ("b", 0.3, 2), ("tiny", 0.1, 3), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    drawn, shares = mixture.mix(df, w)
    s = {x.source: x for x in shares.collect()}
    assert s["tiny"].mixed_tokens == s["tiny"].available_tokens * 3 and s["none"].mixed_tokens == 0
    assert abs(s["a"].mixed_tokens / s["b"].mixed_tokens - 2) < 0.02 and all(x.most_copies <= x.max_repeats for x in s.values())
    assert {x.source for x in drawn.collect()} == {"a", "b", "tiny"}
    assert mixture.mix(df.limit(0), w)[0].count() == 0


def test_every_source_meets_its_plan(spark):
    """One very long note among short ones, and lengths of a heavy tail: off by the shortest note or 0.1 % at most."""
    r = random.Random(9)
    rows = [(i, "long", "word " * int(r.lognormvariate(5, 1.5) + 1)) for i in range(300)] + [(1000 + i, "short", "word " * r.randint(1, 20)) for i in range(900)] + [(5000, "short", "word " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    w = spark.createDataFrame([("long", 0.37, 1), ("short", 0.63, 2)], "source string, target_share double, max_repeats int")
    for fan in (mixture.FAN, 1):
        mixture.FAN, held = fan, mixture.FAN
        mixture.BLOCK_ROWS, rows_held = 100, mixture.BLOCK_ROWS
        try:
            shares = mixture.mix(df, w, 60_000)[1].collect()
        finally:
            mixture.FAN, mixture.BLOCK_ROWS = held, rows_held
        assert all(abs(s.mixed_tokens - s.planned_tokens) <= max(0.001 * s.planned_tokens, 5) for s in shares), shares
        assert all(s.most_copies <= s.max_repeats for s in shares)


# ---- pieces


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["word ", "Dr. X ", "end. ", "a, ", "\n", "\n\n", "体重。", "ไม่มี ", "🙂", "longlonglong"]), max_size=120), st.sampled_from([(8, 0), (16, 3), (40, 10)]))
def test_pieces_join_and_fit(parts, profile):
    limit, overlap = profile
    text = "".join(parts)
    ids = np.array(tk.encoding().encode_ordinary(text), np.int64)
    got = pieces.cuts(pieces.grades(ids), limit, overlap)
    if not len(ids):
        return
    assert got[0][0] == 0 and got[-1][1] == len(ids) and all(0 < e - s <= limit for s, e in got)
    assert all(a[1] - b[0] >= overlap and b[1] > a[1] for a, b in zip(got, got[1:]))
    raw = [b for i in ids for b in tk.token_bytes()[i]]
    ends = np.concatenate([[0], np.cumsum(tk.token_lengths()[ids])])
    for s, e in got:
        bytes(raw[ends[s] : ends[e]]).decode("utf-8")


def test_split_notes(spark):
    df = spark.createDataFrame([(1, "One two three. " * 30), (2, "short"), (3, None), (4, "")], "doc_id long, text string").withColumn("profile", F.lit("clash"))
    limits = spark.createDataFrame([("p", 20, 4), ("p", 20, 4), ("q", 9999, 0), (None, 3, 0)], "profile string, max_tokens int, overlap_tokens int")
    rows = pieces.split_notes(df, limits).orderBy("piece_no").collect()
    assert {r.doc_id for r in rows} == {1} and all(r.token_end - r.token_begin <= 20 for r in rows)
    assert all(a.token_end - b.token_begin == 4 for a, b in zip(rows, rows[1:])) and all(r.piece.endswith(".") for r in rows[:-1])
    assert pieces.split_notes(df, limits.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pieces.split_notes(df, spark.createDataFrame([("p", 4, 4)], "profile string, max_tokens int, overlap_tokens int"))


def _price(g, found, limit, overlap):
    target = (len(g) - overlap) / -(-(len(g) - overlap) // (limit - overlap)) + overlap
    prices = sum(pieces.PENALTY[g[e]] + 0.5 * (s < e - overlap) for (_, e), (s, _) in zip(found, found[1:]))
    return prices + sum(pieces.IMBALANCE * ((e - s) / target - 1) ** 2 for s, e in found)


def _least(g, limit, overlap):
    """The least price over all positions of the grades offered, by trying each pair."""
    n = len(g)
    target = (n - overlap) / -(-(n - overlap) // (limit - overlap)) + overlap
    best = {0: 0.0}
    offered = {int(x) for x in np.flatnonzero(g <= pieces.CLAUSE)}
    for grade in (pieces.WORD, pieces.CHAR):
        edges = [0, *sorted(offered), n]
        offered |= {x for a, b in zip(edges, edges[1:]) if b - a > limit - overlap for x in range(a + 1, b) if g[x] == grade}
    for p in [*sorted(x for x in offered if x > overlap), n]:
        costs = []
        for q, c in best.items():
            s = max(q - overlap, 0)
            while s > 0 and g[s] == pieces.NONE:
                s -= 1
            if p - s <= limit:
                costs.append(c + pieces.IMBALANCE * ((p - s) / target - 1) ** 2 + (0.5 if q and s < q - overlap else 0.0))
        if costs:
            best[p] = min(costs) + (pieces.PENALTY[g[p]] if p < n else 0.0)
    return best.get(n)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 600), st.sampled_from([(8, 0), (64, 0), (40, 10), (256, 32), (300, 200)]), st.sampled_from([(0, 0, 1, 1, 20, 60, 0), (1, 2, 9, 9, 40, 20, 0), (0, 0, 0, 1, 9, 90, 20), (5, 5, 30, 30, 30, 0, 0)]))
def test_cuts_are_the_optimum(seed, n, profile, weights):
    limit, overlap = profile
    g = np.array(random.Random(seed).choices(range(7), weights, k=n), np.int8)
    run = 0
    for i, x in enumerate(g):  # a character has four tokens at most
        run = run + 1 if x == pieces.NONE else 0
        if run > 3:
            g[i], run = pieces.CHAR, 0
    g[0] = pieces.NONE
    found = pieces.cuts(g, limit, overlap)
    least = _least(g, limit, overlap) if n > limit else None
    assert found[0][0] == 0 and found[-1][1] == n and all(0 < e - s <= limit for s, e in found)
    assert all(g[e] != pieces.NONE and e - s >= overlap for (_, e), (s, _) in zip(found, found[1:]))
    if least is not None:
        assert _price(g, found, limit, overlap) == pytest.approx(least)


def test_cuts_keep_the_boundary_that_makes_a_note_feasible():
    g = np.full(6050, pieces.CHAR, np.int8)
    g[0], g[5::5] = pieces.NONE, pieces.WORD
    ends = [210, 428, *range(650, 6000, 210)]
    g[[*ends, 420]] = pieces.SENTENCE
    assert [e for _, e in pieces.cuts(g, 256, 32)] == [*ends, 6050]


def test_only_the_stretch_without_a_place_is_cut_hard():
    g = np.full(300, pieces.WORD, np.int8)
    g[::10] = pieces.SENTENCE
    g[0], g[101:140] = pieces.NONE, pieces.NONE
    found = pieces.cuts(g, 20, 0)
    assert all(0 < e - s <= 20 for s, e in found) and [e for _, e in found[:-1] if g[e] == pieces.NONE] == [120]
    assert all(g[e] == pieces.SENTENCE for _, e in found[:-1] if not 100 < e < 140)
