import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardmill import resources, sources
from wardmill.functions import machines as M
from wardmill.functions.tokens import shape, term_tokens, tokenize
from wardmill.operators import attributes, lookup, nested, rejects, smoking, tagging, tasks

# ---- nested records


def brute_nodes(o):
    """Nodes by plain recursion over a record with canonical keys."""
    keys = ["content", "umlsConcepts", "sabConcepts", "vocabConcepts"]
    names = ["section", "concept", "sab", "vocab"]
    label = ["id", "cui", "codingScheme", "code"]
    out = []

    def down(node, level, at):
        v = node.get(keys[level])
        for i, e in enumerate(v if isinstance(v, list) else [] if v is None else [v]):
            if isinstance(e, dict):
                k = e.get(label[level])
                out.append((names[level], *[*at, i, -1, -1, -1][:4], "" if k is None else str(k)))
                if level < 3:
                    down(e, level + 1, [*at, i])

    down(o, 0, [])
    return sorted(out)


leaf = st.fixed_dictionaries({}, optional={"code": st.one_of(st.none(), st.integers(0, 9), st.text("ab", max_size=2)), "tty": st.just(["PT"])})


def listed(x):
    return st.one_of(st.none(), st.lists(st.one_of(st.none(), x), max_size=3), x)


sab = st.fixed_dictionaries({}, optional={"codingScheme": st.sampled_from(["A", None]), "vocabConcepts": listed(leaf)})
concept = st.fixed_dictionaries({}, optional={"cui": st.text("C1", max_size=3), "sabConcepts": listed(sab)})
section = st.fixed_dictionaries({}, optional={"id": st.integers(0, 5), "umlsConcepts": listed(concept)})


@settings(max_examples=150, deadline=None)
@given(st.fixed_dictionaries({"content": listed(section)}))
def test_pivot_equals_recursion(record):
    tables = nested.pivot(record, nested.CLINICAL_KEYS)
    got = []
    for i, (name, rows) in enumerate(zip(["section", "concept", "sab", "vocab"], tables)):
        for r in rows:
            places = [r[p] for p in nested.positions(nested.CLINICAL_KEYS)[: i + 1]] + [-1] * (3 - i)
            v = r.get(nested.CLINICAL_KEYS[i].fields[0][0])
            got.append((name, *places, "" if v is None else v))
    assert sorted(got) == brute_nodes(record)


def test_all_roots_are_shredded(spark):
    late = {"note": [{"n": i} for i in range(200)], "envelope": {"inner": [{"content": [{"id": 7}]}]}}
    several = {"a": {"content": [{"id": 1}, None, {"id": 2, "umlsConcepts": [{"cui": "C1"}]}]}, "b": json.dumps({"Content": {"id": 3}})}
    df = spark.createDataFrame([(1, json.dumps(late)), (2, json.dumps(several)), (3, json.dumps({"x": [1] * 100}))], "k int, payload string")
    shredded = nested.Shredded(nested.shred(df, "k", "payload", [F.lit(1)]), "k")
    got = sorted((r.k, r.section_pos, r.id) for r in shredded.table("section").collect())
    assert got == [(1, 0, "7"), (2, 0, "1"), (2, 2, "2"), (2, 3, "3")]
    assert [(r.k, r.section_pos, r.cui) for r in shredded.table("concept").collect()] == [(2, 2, "C1")]
    assert [(r.k, r.error) for r in shredded.errors().collect()] == [(3, "no root list")]


def test_shred_spellings_wraps_and_dirt(spark):
    inner = {"Content": [{"Id": 0, "umls_concepts": {"cui": "C1", "SabConcepts": json.dumps([{"codingScheme": "X", "vocabConcepts": [None, {"code": 7, "tty": "PT"}]}])}}]}
    rows = [(1, json.dumps({"icd10": inner}), 5), (1, json.dumps({"icd10": inner}), 9), (2, None, 1), (3, "  ", 1), (4, '{"content": [', 1), (5, "[1, 2]", 1), (6, '{"content": null}', 1), (None, '{"content": {"id": "a"}}', 1)]
    df = spark.createDataFrame(rows, "response_id long, payload string, received_at int").withColumn("level", F.lit("clash"))
    out = nested.Shredded(nested.shred(df, "response_id", "payload", [F.col("received_at")]), "response_id")
    assert sorted((str(r.response_id), r.level, r.vocab_pos, r.node_key) for r in out.nodes().collect()) == [("1", "concept", -1, "C1"), ("1", "sab", -1, "X"), ("1", "section", -1, "0"), ("1", "vocab", 1, "7"), ("None", "section", -1, "a")]
    assert out.table("vocab").collect()[0].tty == ["PT"]
    assert {r.response_id for r in out.errors().collect()} == {2, 3, 4, 5}
    empty = nested.shred(df.limit(0), "response_id", "payload", [F.col("received_at")])
    assert empty.count() == 0


def test_levels_of_any_depth_and_lists_one_wrapper_down(spark):
    levels = tuple(nested.Level(x, x + "s", (("name", "name", "text"),)) for x in "abcde")
    record = {"as": [{"name": "1", "bs": {"cs": 0, "name": "2"}}, {"wrap": {"deeper": {"bs": [None, {"name": "3", "cs": [{"ds": [{"es": [{"name": "deep"}]}]}]}]}}}]}
    df = spark.createDataFrame([(1, json.dumps(record))], "k int, payload string")
    out = nested.Shredded(nested.shred(df, "k", "payload", [F.lit(1)], levels), "k", levels)
    assert [(r.a_pos, r.b_pos, r.c_pos, r.d_pos, r.e_pos, r["name"]) for r in out.table("e").collect()] == [(1, 1, 0, 0, 0, "deep")]
    assert sorted((r.a_pos, r.b_pos, r["name"]) for r in out.table("b").collect()) == [(0, 0, "2"), (1, 1, "3")]
    assert max(r.level for r in out.nodes().collect()) == "e"


def test_one_level_equals_all_levels(spark):
    payload = {"docId": "d", "age": 7, "content": [{"id": i, "umlsConcepts": [{"cui": f"C{i}", "sabConcepts": [{"codingScheme": "S"}]}]} for i in range(3)]}
    df = spark.createDataFrame([(1, json.dumps(payload)), (1, json.dumps(payload)), (2, "{}")], "k int, payload string")
    whole = nested.Shredded(nested.shred(df, "k", "payload", [F.lit(1)]), "k")
    for name in ("section", "concept", "sab", "vocab"):
        one = nested.Shredded(nested.shred(df, "k", "payload", [F.lit(1)], keep=(name,)), "k")
        assert one.table(name).schema == whole.table(name).schema and sorted(map(str, one.table(name).collect())) == sorted(map(str, whole.table(name).collect()))
    root = nested.Shredded(nested.shred(df, "k", "payload", [F.lit(1)], keep=("response",), root=nested.ROOT), "k")
    assert [(r.k, r.doc_id, r.dob, r.age) for r in root.table("response").collect()] == [(1, "d", None, "7")]


def test_groups_found_from_paths(spark):
    rows = [(1, '{"x": {"y": 1}, "Items": [{"id": 1, "tags": ["a", "b"]}, {"id": 2, "sub": {"parts": [{"p": 3}]}}]}'), (2, '[{"q": null}]'), (3, None), (4, "{bad"), (1, '{"x": 9}')]
    df = spark.createDataFrame(rows, "k int, payload string").withColumn("fields", F.lit("clash"))
    found = {(r.ancestor, r.column): r.n for r in nested.ancestors(df, "payload").collect()}
    assert found[("items[]", "id")] == 2 and found[("items[].tags[]", "")] == 2 and found[("items[].sub.parts[]", "p")] == 1 and found[("", "x.y")] == 1 and found[("[]", "q")] == 1
    table = nested.group_table(df, "k", "payload", [F.length("payload").cast("int") * -1], "items[].sub.parts[]").collect()
    assert [(r.k, r.ordinals, r.parent, r.fields) for r in table] == [(1, [1, 0], [1], {"p": "3"})]
    assert sorted((r.ordinals, r.fields[""]) for r in nested.group_table(df, "k", "payload", [F.length("payload") * -1], "items[].tags[]").collect()) == [([0, 0], "a"), ([0, 1], "b")]
    assert nested.group_table(df.limit(0), "k", "payload", [F.lit(1)], "x").count() == 0


# ---- broken lines

GOOD = "C0000001|T047|PT|1|SAB|a term|pref"


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        (GOOD, ""), (GOOD + "\r", ""), ("c0000001 |[t047, T048]|PT|1|S|x|p", ""), ('C0000001|T047|PT|1|S|"a | ""b"""|p', ""), ("C0000001|T047|PT|1|S|5\" long|p", ""),
        (None, None), ("", None), ("  \r", None), ("# C1", None), ("// x", None),
        ('C0000001|T047|PT|1|S|"open|p', "quoting"), ('C0000001|T047|PT|1|S|"a"b|p', "quoting"), ("C0000001|T047", "column_count"), (GOOD + "|x", "column_count"),
        ("C000000l|T047|PT|1|S|x|p", "bad_cui"), ("C0000001|T47|PT|1|S|x|p", "bad_tui"), ("C0000001|[T047|PT|1|S|x|p", "bad_tui"), ("C0000001|T047|PT|1|S| |p", "empty_str"), ("C0000001|T047|PT|1|S|a\tb|p", "bad_chars"), ("C0000001|T047|PT|1|S|a�b|p", "bad_chars"),
    ],
)
def test_term_lines(line, reason):
    got = rejects.judge(line, rejects.TERMS)
    assert (None if got is None else got[0]) == reason


def test_rule_lines():
    for line, reason in [("ies|y", ""), ("s|", ""), ("é-'|ü", ""), ("|y", "bad_rule"), ("a b|c", "bad_rule"), ("a|1", "bad_rule"), ("a|b|c", "column_count"), ('"a|b', "quoting")]:
        assert rejects.judge(line, rejects.RULES)[0] == reason


def test_file_resumes_at_anchor():
    text = '\n'.join([GOOD, 'C0000002|T047|PT|1|S|"never closed|p', GOOD.replace("1|T", "3|T"), 'C0000004|T047|PT|1|S|"two', 'lines"|p', "# end"])
    got = [(n, reason) for n, reason, _, _ in rejects.parse_file(text, rejects.TERMS)]
    assert got == [(1, ""), (2, "quoting"), (3, ""), (4, "")]
    assert [f[5] for _, r, f, _ in rejects.parse_file(text, rejects.TERMS) if not r][-1] == "two\nlines"
    broken = [at for _, r, _, at in rejects.parse_file(text, rejects.TERMS) if r]
    assert text[broken[0] :].startswith('"never')


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["good", "two", "open", "# x", "", "bad"]), max_size=12))
def test_every_record_behind_a_broken_quote_is_found(kinds):
    lines, want = [], []
    for i, k in enumerate(kinds):
        head = f"C{i:07d}|T047|PT|1|S|"
        if k == "two":
            lines.append(head + '"a\r\nb | ""c"""|p')
            want.append(("", 'a\r\nb | "c"'))
        elif k == "open":
            lines.append(head + '"open|p')
            want.append(("quoting", None))
        elif k == "bad":
            lines.append("C1|T047|PT|1|S|x|p")
            want.append(("bad_cui", None))
        else:
            lines.append(head + "plain|p" if k == "good" else k)
            want += [("", "plain")] if k == "good" else []
    # a line that isn't an anchor may only stand where no open quote would take it in
    if any(a == "open" and b in ("bad", "# x", "") for a, b in zip(kinds, kinds[1:])):
        return
    got = [(r, f[5] if f else None) for _, r, f, _ in rejects.parse_file("\n".join(lines), rejects.TERMS)]
    assert got == want


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.bsv").write_text('\n'.join([GOOD, 'C0000002|T047|PT|1|S|"never|p', 'C0000004|T047|PT|1|S|"two', 'lines"|p']))
    (tmp_path / "b.bsv").write_text("")
    rows = rejects.read_files(spark, str(tmp_path), rejects.TERMS).orderBy("line_no").collect()
    assert [(r.line_no, r.reason, r.fields[5] if r.fields else None) for r in rows] == [(1, None, "a term"), (2, "quoting", None), (3, None, "two\nlines")]
    long = "\n".join(['C0000001|T047|PT|1|S|"open|p'] * 20_000)
    assert sum(r == "quoting" for _, r, _, _ in rejects.parse_file(long, rejects.TERMS)) == 20_000


def test_rejected_once_and_accepted(spark):
    rows = [(1, "./a//b", 1, "x|y|z", 2), (1, "a/b", 1, "x|y|z", 1), (2, None, 2, "ies|y", 1), (3, "p", 3, None, None)]
    df = spark.createDataFrame(rows, "line_id long, file_path string, line_no int, line string, loaded_at int").withColumn("reason", F.lit("clash"))
    assert [(r.table_name, r.line_id, r.file_path, r.reason) for r in rejects.rejected(df, rejects.RULES).collect()] == [("rule_lines", 1, "a/b", "column_count")]
    assert [(r.line_id, r.suffix, r.replacement) for r in rejects.accepted(df, rejects.RULES).collect()] == [(2, "ies", "y")]
    assert rejects.rejected(df.limit(0), rejects.RULES).count() == 0


# ---- tokens and automata


@settings(max_examples=200, deadline=None)
@given(st.text("ab1 .,'-@/:%\n\té(", max_size=40))
def test_tokens_cover_text(s):
    tokens = tokenize(s, 7)
    assert all(a.end <= b.begin for a, b in zip(tokens, tokens[1:]))
    covered = {i for t in tokens for i in range(t.begin - 7, t.end - 7)}
    assert all(c in " \t" or i in covered for i, c in enumerate(s))
    assert all(len(t.text) == len(t.shape) == t.end - t.begin for t in tokens)


def test_tokens_golden():
    assert [t.text for t in tokenize("She can't; cannot go, 1,200 mg p.o. at 8:30 x-ray 555-1234 now")] == ["she", "ca", "n't", ";", "can", "not", "go", ",", "1,200", "mg", "p.o.", "at", "8", ":", "30", "x-ray", "555-1234", "now"]
    assert tokenize("") == [] and shape("Ab9") == "Xxd"
    assert term_tokens("knee's 1.5 x-ray") == ["knee", "'s", "1", ".5", "x-ray"]


def spans(machine, s):
    return [s[x.begin : x.end] for x in machine.run(tokenize(s))]


def test_machines():
    dates = lambda s: [s[x.begin : x.end] for x in M.date_spans(tokenize(s))]
    assert dates("on October 15, 2002 and 10/15/94 x") == ["October 15, 2002", "10/15/94"] and dates("seen 10-15 now") == ["10-15"] and dates("in Oct. 2002 x") == ["Oct. 2002"]
    units = lambda s: {(s[x.begin : x.end], x.value) for m in M.FREQUENCY_UNITS for x in m.run(tokenize(s))}
    assert ("t . i . d .", "3.0") in units("take t . i . d . now then") and ("q . w . k .", "") in units("q . w . k . now then") and units("b . i . d . x y") >= {("b . i . d .", "2.0")}
    assert spans(M.RANGE_STRENGTH[1], "give 2 . 5 - 3 tabs") == ["2 . 5 - 3"] and not M.RANGE_STRENGTH[0].run(tokenize("two - three x")) and M.RANGE_STRENGTH[0].meant().run(tokenize("two - three x"))
    assert [m.value for m in M.SUBSECTIONS if m.meant().run(tokenize("past medications : x"))] == ["history"]
    assert spans(M.LAB_RANGE, "goal 250-300 now") == ["250-300"]
    assert spans(M.LAB_FRACTION, "one half or 1/2 x") == ["one half", "1/2"]
    assert spans(M.FORM, "a tablet or a pill x")[0] == "tablet"
    assert [m.value for m in M.ROUTES if m.run(tokenize("given by mouth now"))] == ["Enteral_Oral"]
    assert M.negated(tokenize("denies pain x")) and not M.negated(tokenize("has pain x"))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("denies no evidence of rule out can not any without has pain negative".split()), max_size=7))
def test_negation_fold_inputs(words):
    from wardmill.functions.tokens import Token

    tokens = [Token(0, 0, w, "word", "") for w in [*words, "<eos>"]]
    M.negated(tokens)


def test_native_negation_equals_machines(spark):
    import itertools

    from wardmill.functions.tokens import Token

    vocabulary = "denies no evidence rule out can not without has negative".split()
    cases = [list(c) for n in range(4) for c in itertools.product(vocabulary, repeat=n)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, w array<string>")
    got = {r.i: r.n for r in df.select("i", attributes.negated_words(F.col("w")).alias("n")).collect()}
    want = {i: M.negated([Token(0, 0, w, "word", "") for w in [*c, "<eos>"]]) for i, c in enumerate(cases)}
    assert got == want


def test_drug_and_lab():
    s = "takes metformin 500 mg tablet orally twice daily now."
    r = attributes.drug_attributes(s, tokenize(s), [(6, 15)])[0]
    assert (r["strength"], r["unit"], r["form"], r["route"], r["frequency"], r["duration"]) == ("500", "mg", "tablet", "Enteral_Oral", "2.0", None)
    got = attributes.link_labs("glucose 98 mg/dl", [(0, 7)])[0]
    assert (got["begin"], got["end"], got["value"], got["unit"], got["unit_at"]) == (0, 7, "98", "mg/dl", (11, 16))
    assert attributes.drug_attributes("", [], [(0, 1)])[0]["strength"] is None
    bag = attributes.drug_bag(s, 0, attributes.drug_places(tokenize(s), [(6, 15)])[0])
    assert bag["medStrengthNum"] == ["500", 16, 19] and bag["medFrequencyNumber"] == ["2.0", 37, 42] and bag["medStatusChange"] is None
    model = {"features": {"a": 0}, "states": ["N", "L"], "initial_weights": [0.0], "final_weights": [0, 0], "transitions": [[{"weights": [-5], "default_weight": 0}, {"weights": [5], "default_weight": -1}]] * 2}
    assert attributes.viterbi([{"a"}, set()], model) == [1, 0] and attributes.viterbi([], model) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["LV_POINT_VALUE_1", "LV_POINT_TERM_1", "LV_PUNCTUATION_:", "LV_DISTANCE", "LV_CONJ_AND", "other"]), max_size=4), min_size=1, max_size=6))
def test_crf_equals_all_sequences(features):
    import itertools

    model = resources.read_model(resources.LAB_CRF)

    def score(states):
        total, last = model["initial_weights"][0], 0
        for f, s in zip(features, states):
            t = model["transitions"][last][s]
            total, last = total + t["default_weight"] + sum(t["weights"][model["features"][x]] for x in set(f) if x in model["features"]), s
        return total + model["final_weights"][last]

    best = max(itertools.product((0, 1), repeat=len(features)), key=score)
    assert score(attributes.viterbi([set(f) for f in features], model)) == pytest.approx(score(best))


def test_crf_links():
    model = resources.read_model(resources.LAB_CRF)
    text = "glucose 98 , sodium 140 and potassium 4.1 seen on 10/15/94"
    got = attributes.link_labs(text, [(text.index(w), text.index(w) + len(w)) for w in ("glucose", "sodium", "potassium")], model)
    assert [r["value"] for r in got] == ["98", "140", "140"]
    assert attributes.link_labs("no mention 5", [], model) == [] and attributes.link_labs("glucose high", [(0, 7)], model)[0]["value"] is None


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.floats(-2, 2), min_size=3, max_size=3), min_size=1, max_size=5), st.sampled_from(["linear", "poly", "rbf", "sigmoid", "regression"]))
def test_svm_labels_equal_row_by_row(rows, kind):
    import numpy as np

    model = {"kernel": "linear" if kind == "regression" else kind, "gamma": 0.5, "coef0": 0.1, "degree": 2, "counts": [1, 2, 1], "vectors": [[1, 0, 0], [0, 1, 0], [0.5, 1, 1], [0, 0, 1]], "coefficients": [[0.3, -0.7, 0.2, -1], [1, 0.5, -0.2, 0.9]], "rho": [0.1, -0.2, 0.05]}
    model |= {} if kind == "regression" else {"labels": [1, 2, 3]}
    assert list(smoking.svm_labels(np.array(rows, float), model)) == pytest.approx([smoking.svm_predict(r, model) for r in rows])


def test_lab_units_are_the_whole_list(spark):
    assert len(resources.LAB_UNITS) == 498
    for u in sorted(resources.LAB_UNITS):
        text = f"value 7 {u.upper()} seen"
        assert attributes.unit_after(text, 7) == (8, 8 + len(u)), u
    for text, value, unit in [("wbc 5 10*3/ul", "5", "10*3/ul"), ("wbc 5k/ul today", "5", "k/ul"), ("wbc is 5cm h2o now", "5", "cm h2o"), ("wbc 5cm", "5", "cm"), ("wbc 80 beats/min", "80", "beats/min"), ("wbc 400 copies/mL .", "400", "copies/mL"), ("wbc 3 days", "3", "days"), ("wbc 5zork", None, None)]:
        got = attributes.link_labs(text, [(0, 3)])[0]
        assert (got["value"], got["unit"]) == (value, unit), text
    df = spark.createDataFrame([(1, "wbc 5zorks here", "wbc"), (2, "wbc 5 cm", "wbc")], "k int, text string, lab string")
    rows = attributes.with_lab_values(df, "k", "text", "lab", units=["Zorks"]).orderBy("k").collect()
    assert [(r.value, r.unit) for r in rows] == [("5", "zorks"), ("5", None)]


def test_smoking():
    for s, want in [("he smokes daily", "CURRENT_SMOKER"), ("denies smoking", "NON_SMOKER"), ("quit smoking", "PAST_SMOKER"), ("walks", "UNKNOWN"), ("tobacco use", "SMOKER"), ("non-smoker", "NON_SMOKER"), ("", "UNKNOWN")]:
        assert smoking.sentence_status(s) == want, s
    assert smoking.merge_sentences(["Tobacco:", "none.", "Walks."]) == ["Tobacco: none.", "Walks."]
    assert smoking.svm_predict([2.0, 0.0], {"labels": [1, 2], "counts": [1, 1], "vectors": [[1, 0], [0, 1]], "coefficients": [[1, -1]], "rho": [0]}) == 1


# ---- lookup


def test_lookup_equals_brute_force(spark):
    import random

    r = random.Random(3)
    words = ["left", "knee", "pain", "of", "the", "cough", "боль", "früh"]
    docs = [(i, " ".join(r.choice([*words, "stop.", "end.\n"]) for _ in range(r.randint(0, 14)))) for i in range(60)] + [(99, None), (98, "")]
    terms = [(f"c{i}", " ".join(r.choice(words) for _ in range(r.randint(1, 3)))) for i in range(25)] + [("z", ""), ("y", None), ("x", "knee"), ("w", "knee")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("term", F.lit("clash"))
    t = spark.createDataFrame(terms, "cui string, str string")
    want = set()
    for i, s in docs:
        sentences = [x.replace(".", "").split() for x in (s or "").replace("\n", " ").split(". ")]
        for k, w in enumerate(x for x in sentences if x):
            want |= {(i, k, z, a, a + len(q)) for _, z in terms if z for q in [z.split()] for a in range(len(w) - len(q) + 1) if w[a : a + len(q)] == q}
    got = [(x.doc_id, x.sent_no, x.term, x.begin, x.end) for x in lookup.spans(d, t).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    members = {(x.cui, x.term) for x in lookup.membership(t, lookup.plain_tokens(F.col("str")), ["cui"]).collect()}
    assert members == {(c, z) for c, z in terms if z}


def test_lookup_finds_terms_of_any_length(spark):
    words = [f"w{i}" for i in range(60)]
    d = spark.createDataFrame([(1, "x " + " ".join(words)), (2, " ".join(words[3:20]) + " end")], "doc_id long, text string")
    t = spark.createDataFrame([("a", " ".join(words[3:13])), ("b", " ".join(words)), ("c", " ".join([*words[3:20], "end"])), ("d", "w7"), ("e", " ".join([*words[:40], "other"]))], "cui string, str string")
    name = dict(zip((x.str for x in t.collect()), "abcde"))
    got = sorted((x.doc_id, name[x.term], x.begin, x.end) for x in lookup.spans(d, t).collect())
    assert got == [(1, "a", 4, 14), (1, "b", 1, 61), (1, "d", 8, 9), (2, "a", 0, 10), (2, "c", 0, 18), (2, "d", 4, 5)]
    assert lookup.spans(d, t.limit(0)).count() == 0


def test_lookup_by_lemma(spark):
    s = spark.createDataFrame([(1, 0, ["both", "knees", "ache"], ["both", "knee", None], [True, True, True]), (2, 0, ["knees"], ["knee"], [False]), (3, 0, [], [], [])], "k int, sent_no int, w array<string>, l array<string>, ok array<boolean>")
    t = spark.createDataFrame([("a", "knee"), ("b", "knee ache"), ("c", "knees"), ("d", "knees ache")], "cui string, str string")
    index = lookup.term_classes(t, lookup.plain_tokens(F.col("str")))
    found = lookup.matches(lookup.anchors(s, ["k", "sent_no"], F.col("w"), lookup.reach_of(t, lookup.plain_tokens(F.col("str"))), F.col("l"), F.col("ok")), index, ["k", "sent_no"])
    assert sorted((r.k, r.term, r.begin, r.end) for r in found.collect()) == [(1, "knee", 1, 2), (1, "knee ache", 1, 3), (1, "knees", 1, 2), (1, "knees ache", 1, 3)]


def test_longest_equals_anti_join(spark):
    import random

    r = random.Random(4)
    rows = list({(r.randint(0, 3), b, b + r.randint(1, 6)) for b in (r.randint(0, 25) for _ in range(150))})
    got = {(x.k, x.begin, x.end) for x in lookup.longest(spark.createDataFrame(rows, "k int, begin int, end int"), ["k"]).collect()}
    want = {a for a in rows if not any(b[0] == a[0] and b != a and b[1] <= a[1] and b[2] >= a[2] for b in rows)}
    assert got == want


# ---- tasks, configurations, words, tags


@pytest.mark.parametrize(
    ("status", "canceled", "stop", "failed", "attempts", "want"),
    [("completed - success", True, True, True, 9, "skip"), ("started", True, True, True, 9, "canceled"), ("started", False, True, True, 9, "canceled: document failed"), ("started", False, True, False, 3, "completed - failure"), ("started", None, None, None, None, "run"), (None, False, False, True, 2, "run")],
)
def test_decisions(spark, status, canceled, stop, failed, attempts, want):
    df = spark.createDataFrame([(status, canceled, stop, failed, attempts)], "s string, c boolean, j boolean, f boolean, a int")
    assert df.select(tasks.decision(F.col("s"), F.col("c"), F.col("j"), F.col("f"), F.col("a"))).first()[0] == want


def test_partial_documents(spark):
    rows = [('{"a":1,"z":{"y":[true,null]}}', '{"a":2.5,"n":"x"}'), ("{}", '{"a":null}')]
    df = spark.createDataFrame(rows, "raw string, new string")
    got = [json.loads(r[0]) for r in df.select(tasks.updated(F.col("raw"), F.col("new"))).collect()]
    assert got == [{"a": 2.5, "z": {"y": [True, None]}, "n": "x"}, {"a": None}]


SCENARIOS = [
    # chunk status, attempts, job there, canceled, stops on failure, document there, document failed, annotation fails, redelivered -> status, action
    ("completed - success", 0, True, True, True, True, True, False, False, None, "ack"), ("completed - failure", 9, False, False, False, False, False, False, False, None, "ack"),
    ("started", 0, True, True, False, True, False, False, False, "canceled", "ack"), ("started", 9, True, True, True, False, False, False, False, "canceled", "ack"),
    ("started", 0, True, False, True, True, True, False, False, "canceled", "ack"), ("started", 3, True, False, True, True, True, False, False, "canceled", "ack"),
    ("started", 3, True, False, False, True, False, False, False, "completed - failure", "ack"), ("failed", 5, True, False, True, True, False, False, False, "completed - failure", "ack"),
    ("started", 2, True, False, False, True, False, False, False, "completed - success", "ack"), ("submitted", None, True, False, False, False, False, False, True, "completed - success", "ack"),
    ("failed", 1, True, False, True, True, False, True, False, "failed", "ack"), ("failed", 1, True, False, False, True, False, True, True, "failed", "ack"),
    ("started", 0, False, False, False, True, False, False, False, None, "requeue"), ("started", 0, False, False, False, True, False, False, True, None, "drop"),
    ("started", 0, True, False, True, False, False, False, False, None, "requeue"), ("started", 0, True, False, True, False, False, False, True, None, "drop"),
    (None, 0, True, False, False, True, False, False, False, None, "requeue"), (None, 0, True, False, False, True, False, False, True, None, "drop"),
]


def test_worker_scenarios(spark):
    from wardmill.streaming import process

    n = range(len(SCENARIOS))
    chunks = spark.createDataFrame([(i, i, i, s[0], s[1], None) for i, s in enumerate(SCENARIOS) if s[0]], "chunk_id int, document_id int, job_id int, status string, attempts int, error_messages array<string>")
    jobs = spark.createDataFrame([(i, s[3], s[4]) for i, s in enumerate(SCENARIOS) if s[2]], "job_id int, user_canceled boolean, stop_documents_on_failure boolean")
    documents = spark.createDataFrame([(i, s[6]) for i, s in enumerate(SCENARIOS) if s[5]], "document_id int, document_failed boolean")
    messages = spark.createDataFrame([(i, i, SCENARIOS[i][8]) for i in n], "message_id int, chunk_id int, redelivered boolean")
    fails = [i for i in n if SCENARIOS[i][7]]
    annotate = lambda df: df.select("message_id", F.when(~F.col("message_id").isin(fails), "{}").alias("response"), F.when(F.col("message_id").isin(fails), "bad").alias("error"))
    results, states, failed, deliveries = process(messages, (chunks, documents, jobs), annotate)
    state = {r.chunk_id: r for r in states.collect()}
    action = {r.message_id: r.action for r in deliveries.collect()}
    assert [(state[i].status if i in state else None, action[i]) for i in n] == [s[9:] for s in SCENARIOS]
    assert {r.document_id for r in failed.collect()} == {i for i in n if SCENARIOS[i][9] == "completed - failure"} and {r.message_id for r in results.collect()} == {i for i in n if SCENARIOS[i][9] == "completed - success"}
    assert all(state[i].error_messages == ["bad"] for i in fails) and state[6].error_messages[0].startswith("Task has exceeded retries. (Attempts: 4, max retries: 3")


def test_a_bad_note_harms_no_other(spark, monkeypatch):
    from wardmill.operators import pipeline
    from wardmill.plans.pipeline_queries import _configuration, _lines

    notes = spark.createDataFrame([(1, "She has chest pain."), (2, None), (3, ""), (4, "\ud800 odd"[1:])], "k int, text string").withColumn("config", F.lit("clash"))
    done = {r.k: r for r in pipeline.annotate_notes(notes, "k", _lines(spark), [_configuration("all", "polarity")]).collect()}
    assert json.loads(done[1].response)["content"][0]["text"] == ["chest pain", 8, 18] and json.loads(done[2].response)["content"] == [] == json.loads(done[3].response)["content"]
    broken = pipeline.Models(sentences={"weights": "none"})
    rows = pipeline.with_sentences(notes, "k", "text", broken).collect()
    assert {r.k: bool(r.error) for r in rows} == {1: True, 2: False, 3: False, 4: True}
    with pytest.raises(ValueError):
        pipeline.annotate_notes(notes, "k", None, [])


def test_annotate_one_text(spark):
    from wardmill.operators import pipeline
    from wardmill.plans.pipeline_queries import _configuration, _lines

    got = json.loads(pipeline.annotate(spark, "Denies chest pain.".encode(), _lines(spark), [_configuration("a", "polarity"), _configuration("s", kind="smoking_status")]))
    assert got["a"]["docId"] == "test_api" and got["a"]["content"][0]["attributes"] == {"polarity": "negative"} and got["s"]["smokingStatus"] == "UNKNOWN"
    with pytest.raises(ValueError):
        pipeline.annotate(spark, b"\xff", _lines(spark), [_configuration("a")])


def test_dictionaries(spark, tmp_path):
    (tmp_path / "v.bsv").write_text("# head\nC1|a\nC2|b\nC3|last")
    whole = sources.read_dictionary(spark, str(tmp_path), "v.bsv")
    assert [r.line for r in whole.orderBy("line_no").collect()] == ["# head", "C1|a", "C2|b", "C3|last"]
    assert [r.cui for r in sources.scheme_columns(sources.read_dictionary(spark, str(tmp_path), "v.bsv", True), "CUI|STR", ["line_no"]).orderBy("line_no").collect()] == ["c1", "c2"]
    built = []
    build = lambda lines: built.append(1) or lines.select("line")
    for text, times in (("C1|a", 1), ("C1|a", 1), ("C1|b", 2)):
        lines = spark.createDataFrame([(text,)], "line string")
        assert [r.line for r in sources.cached_index(spark, lines, "CUI|STR", str(tmp_path / "cache"), build).collect()] == [text] and len(built) == times


def test_a_folder_of_configurations_over_a_folder_of_notes(spark, tmp_path):
    """Two files for terms and concepts, notes as text files, the index and the results written."""
    from wardmill.__main__ import main

    for name in ("configs", "words", "notes"):
        (tmp_path / name).mkdir()
    (tmp_path / "configs" / "general.yaml").write_text("params:\n  FDL:\n    term_dictionary: terms.bsv\n    term_scheme: CUI|STR\n    concept_dictionary: concepts.bsv\n    concept_scheme: CUI|TUI|CODE|SAB|PREF\n    exclusion_tags: [VB]\n    precision_mode: True\npipeline: default_clinical\nfeatures: [polarity]\n")
    (tmp_path / "configs" / "smoking.yaml").write_text("pipeline: smoking_status\n")
    (tmp_path / "words" / "terms.bsv").write_text("C1|chest pain\nC2|Cough")
    (tmp_path / "words" / "concepts.bsv").write_text("C1|T184|1|S|Chest Pain\nC2|T184|2|S|cough")
    (tmp_path / "notes" / "a.txt").write_text("No cough.\nHe quit smoking.")
    (tmp_path / "notes" / "b.txt").write_text("Chest pain.")
    place = [str(tmp_path / x) for x in ("configs", "words", "notes", "out")]
    assert main(["annotate", *place]) == 0 and main(["annotate"]) == 2
    assert main(["build-index", place[0], place[1], str(tmp_path / "index")]) == 0 and len(list((tmp_path / "index").iterdir())) == 1
    got = {r.doc_id: json.loads(r.envelope) for r in spark.read.json(place[3]).collect()}
    cough = got["a"]["general"]["content"][0]
    # the concept file's last line isn't terminated: its concept has no group and no codes
    assert cough["text"] == ["cough", 3, 8] and cough["attributes"] == {"polarity": "negative"} and cough["aspect"] == "unknown"
    assert got["a"]["smoking"]["smokingStatus"] == "PAST_SMOKER" and got["b"]["general"]["content"][0]["umlsConcepts"][0]["preferredText"] == "chest pain"


def test_small_helpers(spark):
    from wardmill.operators import pipeline

    df = spark.createDataFrame([(["drug", "lab"], ["x", "lab"]), ([], None), (None, ["y"])], "a array<string>, b array<string>")
    got = df.select(lookup.has_semantic(F.col("a"), "lab").alias("h"), lookup.combined(F.col("a"), F.col("b")).alias("c")).collect()
    assert [r.h for r in got] == [True, False, None] and [r.c for r in got] == [["drug", "lab", "x"], [], ["y"]]
    watched, seen = pipeline.counted(df)
    watched.collect()
    assert seen.get["n"] == 3


def test_no_local_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from wardmill.session import shared_folder

    conf = SimpleNamespace(get=lambda k: None)
    with pytest.raises(ValueError):
        shared_folder(SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077")))


def test_configurations(tmp_path):
    (tmp_path / "a.yaml").write_text("params:\n  FDL:\n    term_scheme: CUI|STR\n    precision_mode: True\npipeline: default_clinical\nfeatures: [lab]\n")
    (tmp_path / "b.yaml").write_text("pipeline: unknown\n")
    (tmp_path / "c.yaml").write_text("a: [")
    (tmp_path / "disabled").mkdir()
    (tmp_path / "disabled" / "d.yaml").write_text("pipeline: default_clinical\n")
    got = sources.load_configurations(str(tmp_path))
    assert [c.name for c in got] == ["a"] and got[0].wants("lab") and not got[0].wants("drug") and got[0].precision_mode


def test_word_files(tmp_path):
    p = tmp_path / "w.txt"
    p.write_text("B|x\nc|y")
    assert resources.read_words(str(p)) == ["b|x", "c|y"] and resources.read_words(str(p), True) == ["b|x"]
    assert resources.read_rules(str(p)) == [("b", "x"), ("c", "y")] and resources.read_words(str(tmp_path / "none")) == []
    p.write_text("a|b|c\n")
    with pytest.raises(ValueError):
        resources.read_rules(str(p))


def test_tagging():
    assert tagging.lemma("Studies", "VBZ", {}, {"verb": [("ies", "y")]}, {"verb": frozenset(["study"])}) == "study"
    assert tagging.lemma("feet", "NNS", {"noun": {"feet": "foot"}}, {}, {}) == "foot" and tagging.lemma("12", "CD", {}, {}, {}) == "0"
    model = {"outcomes": ["nn", "vb"], "weights": {"w=run": {"vb": 2.0}, "t=vb": {"nn": 1.0}}}
    assert tagging.tag(["run", "dog"], model) == ["vb", "nn"] and tagging.tag([], model) == []
    assert tagging.split_fallback("A b. C\n\nD") == [(0, 4), (5, 6), (8, 9)] and tagging.split_fallback("") == []


def test_core_needs_no_training_operators():
    import pathlib
    import re

    root = pathlib.Path(resources.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"wardmill\.llm|from \.llm", p.read_text()), p


def broadcast_rows(df):
    """Rows of the largest table broadcast by the plan that ran."""
    def each(p):
        name = p.getClass().getSimpleName()
        if name == "BroadcastExchangeExec":
            yield p.metrics().apply("numOutputRows").value()
        inside = p.executedPlan() if name == "AdaptiveSparkPlanExec" else p.plan() if name.endswith("QueryStageExec") else None
        children = [inside] if inside is not None else [p.children().apply(i) for i in range(p.children().size())]
        for c in children:
            yield from each(c)

    df.collect()
    return max([0, *each(df._jdf.queryExecution().executedPlan())])


@pytest.mark.parametrize("name", ["pipeline_concepts", "pipeline_features", "pipeline_response"])
def test_pipeline_broadcasts_no_notes(spark, name):
    from wardmill.plans.pipeline_queries import QUERIES

    assert broadcast_rows(QUERIES[name](spark, "/root/testdata/sf0.001")) < 100


def test_pipeline_features_deals_spans_out_once(spark):
    """One sort-merge join, of notes with their spans; the lookup, its places and its responses need none."""
    from wardmill.plans.pipeline_queries import QUERIES

    plan = QUERIES["pipeline_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "shape" not in plan.split("Scan ExistingRDD", 1)[1]


def test_notes_with_and_without_precision_errors_and_null_keys(spark):
    from wardmill.operators import pipeline
    from wardmill.plans.pipeline_queries import _configuration, _lines

    notes = spark.createDataFrame([(1, "Had pain. Denies chest pain."), (2, "Walks."), (None, "She has chest pain.")], "k int, text string")
    done = {(r.k, r.config): r for r in pipeline.annotate_notes(notes, "k", _lines(spark), [_configuration("exact", "polarity"), _configuration("loose", precision=False)]).collect()}
    found = {k: [(c["id"], *c["text"], *c["sentence"], c["attributes"].get("polarity")) for c in json.loads(r.response)["content"]] for k, r in done.items()}
    assert found[1, "exact"] == [(0, "pain", 4, 8, 0, 9, "positive"), (1, "chest pain", 17, 27, 10, 28, "negative")]
    assert found[1, "loose"] == [(0, "pain", 4, 8, 0, 9, None), (1, "chest pain", 17, 27, 10, 28, None), (2, "pain", 23, 27, 10, 28, None)]
    assert len(done) == 6 and all(found[k, c] == [] for k in (2, None) for c in ("exact", "loose"))
    broken = pipeline.annotate_notes(notes, "k", _lines(spark), [_configuration("a")], pipeline.Models(sentences={"weights": "none"})).collect()
    assert [(r.response, bool(r.error)) for r in broken] == [(None, True)] * 3


def test_machines_that_nothing_starts_are_not_run(monkeypatch):
    """As every machine run on every sentence, in fewer runs."""
    from wardmill.functions import machines, tokens

    texts = ["Give metformin 20 mg tablet twice daily.", "Take 2 - 3 tablets by mouth every 8 hours for 10 days.", "Seen on 10/12/2019, stop 1/2 tab p.o. b.i.d.", "She denies chest pain .", ""]
    groups = [machines.TIME, machines.FRACTION_STRENGTH, machines.STATUS, machines.RANGE_STRENGTH, machines.STRENGTH_UNIT, machines.ROUTES, machines.FREQUENCY_UNITS, machines.DURATION, machines.DATES]
    every = [[[s for m in g for s in m.run(tokens.tokenize(x))] for g in groups] for x in texts]
    ran, run = [], machines.Machine.run
    monkeypatch.setattr(machines.Machine, "run", lambda m, *a: ran.append(m) or run(m, *a))
    for _ in range(2):
        assert [[machines.run_all(g, tokens.tokenize(x)) for g in groups] for x in texts] == every
    assert len(ran) < len(texts) * sum(map(len, groups)) and sum(map(len, every[0])) > 0


def test_pipeline_response_reads_notes_on_all_cores(spark):
    from wardmill.operators import pipeline

    notes = spark.range(0, 100, 1, 3).selectExpr("id AS k", "'Give metformin.' AS text")
    assert pipeline.with_sentences(notes, "k").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
