"""Vocabulary lookup as relational algebra.

Terms with equal tokens are one class, indexed by their rarest token; the concepts of a class are rows of a
table of their own (``membership``). A sentence's tokens are exploded with as many neighbours as the longest
term needs, never beyond the sentence, and joined with the classes on the rare token; what the neighbours
confirm is a span. So the result of the lookup grows with the notes alone, however many concepts share a
term, and no duplicates arise that a shuffle would have to remove. Semantic groups and longest spans are
found on (span, class); concepts are joined in by class only where they are asked for. The index and the
tables of classes are checkpointed in the shared folder and measured (``sized``, a job each while the frame
is built): up to ``BROADCAST_BYTES`` they go to the tasks, and the notes aren't shuffled at all; larger ones
are shuffled, and AQE splits their frequent tokens.

Defined cases: null and empty texts have no tokens; a term without tokens never matches; a term of one
token matches even if that token isn't rarable; ties between equally rare tokens go to the first; a term
of any length is found; repeated vocabulary rows count once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wardmill import resources as R
from wardmill.frames import spread
from wardmill.functions.tokens import plain_tokens
from wardmill.session import checkpoint
from wardmill.sources import tui_list

#: What a table of the vocabulary may measure to be broadcast.
BROADCAST_BYTES = 32 << 20
#: Parts the tokens of a class in its name.
JOINT = " "


def sized(table: DataFrame, most: int | None = None) -> DataFrame:
    """A table of the vocabulary, checkpointed; marked for broadcast if its rows as JSON measure ``most`` bytes at most."""
    kept = checkpoint(table)
    size = kept.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]
    return F.broadcast(kept) if size <= (BROADCAST_BYTES if most is None else most) else kept


def rarable(token: Column) -> Column:
    return (F.octet_length(token) > 1) & token.rlike("[a-zA-Z]") & ~token.isin(sorted(R.NOT_RARE))


def term_classes(terms: DataFrame, tokens: Column, group: list[str] | None = None) -> DataFrame:
    """group..., term, tokens, n, rare_idx (from 0), rare_word: one row per distinct token array.

    A token's count is its occurrences over all rows of ``terms`` (within a group); the index is the first of
    the rarest. ``term`` is the tokens joined by a space.
    """
    group = group or []
    base = terms.select(*group, tokens.alias("tokens")).filter(F.size("tokens") > 0).groupBy(*group, "tokens").agg(F.count(F.lit(1)).alias("weight"))
    base = base.withColumns({"term": F.array_join("tokens", JOINT), "n": F.size("tokens")})
    each = base.select(*group, "term", "weight", F.posexplode("tokens").alias("pos", "token"))
    counts = each.filter(rarable(F.col("token"))).groupBy(*group, "token").agg(F.sum("weight").alias("cnt"))
    best = each.join(counts, [*group, "token"]).groupBy(*group, "term").agg(F.min(F.struct("cnt", "pos")).alias("b"))
    out = base.join(best, [*group, "term"], "left").withColumn("rare_idx", F.when(F.col("n") == 1, 0).otherwise(F.coalesce(F.col("b.pos"), F.lit(0))))
    return out.select(*group, "term", "tokens", "n", "rare_idx", F.get("tokens", F.col("rare_idx")).alias("rare_word"))


def membership(terms: DataFrame, tokens: Column, key: list[str]) -> DataFrame:
    """key..., term: which concepts a class names, each pair once."""
    return terms.select(*key, tokens.alias("t")).filter(F.size("t") > 0).select(*key, F.array_join("t", JOINT).alias("term")).distinct()


def reach_of(terms: DataFrame, tokens: Column) -> Column:
    """The length of the longest term less one, as a scalar: one aggregate over the vocabulary."""
    return F.coalesce(terms.agg(F.max(F.size(tokens)) - 1).scalar(), F.lit(0))


def anchors(notes: DataFrame, key: list[str], words: Column, reach: Column, lemmas: Column | None = None, anchor: Column | None = None, places: Column | None = None) -> DataFrame:
    """key..., pos, word, before, window[, lemma_window, place_window]: each token with the ``reach`` tokens on either side.

    With ``lemmas`` (an array beside ``words``) a token is probed by either, by its lemma only where that
    differs. ``anchor`` is an array of booleans beside ``words``: which tokens may anchor a term. ``places``
    (structs of b and e beside ``words``) are where the tokens lie in the text.
    """
    beside = {"l": lemmas, "a": anchor, "p": places}
    base = notes.select(*key, words.alias("w"), *[c.alias(k) for k, c in beside.items() if c is not None])
    base = base.filter(F.size("w") > 0).withColumn("reach", reach)
    out = base.select(*key, *[c for c in base.columns if c not in key], F.posexplode("w").alias("pos", "word"))
    if anchor is not None:
        out = out.filter(F.get("a", F.col("pos")))
    if lemmas is not None:
        out = out.withColumn("word", F.explode(F.array_distinct(F.array("word", F.coalesce(F.get("l", F.col("pos")), F.col("word"))))))
    first = F.greatest(F.col("pos") - F.col("reach"), F.lit(0))
    cut = lambda c: F.slice(c, first + 1, 2 * F.col("reach") + 1)
    return out.select(*key, "pos", "word", (F.col("pos") - first).alias("before"), cut("w").alias("window"), *([cut("l").alias("lemma_window")] if lemmas is not None else []), *([cut("p").alias("place_window")] if places is not None else []))


def matches(anchor: DataFrame, index: DataFrame, key: list[str], group: list[str] | None = None, by: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """key..., group..., term, begin, end (token positions, end exclusive): verified spans.

    With the tokens' places the span's own (first, last) are there too. ``by`` deals the spans out as the
    caller goes on to group them, so that telling them apart needs no shuffle of its own.
    """
    group = group or []
    j = anchor.join(index, anchor.word == index.rare_word)
    start = F.col("before") - F.col("rare_idx")
    from_ = F.greatest(start, F.lit(0)) + 1
    part = F.slice("window", from_, F.col("n"))
    same = part == F.col("tokens")
    lemma = "lemma_window" in anchor.columns
    if lemma:
        either = F.zip_with(F.zip_with(part, F.slice("lemma_window", from_, F.col("n")), lambda w, m: F.struct(w.alias("w"), m.alias("m"))), F.col("tokens"), lambda x, t: F.coalesce((x["w"] == t) | (x["m"] == t), F.lit(False)))
        same = same | (F.size(part) == F.col("n")) & F.forall(either, lambda x: x)
    begin = F.col("pos") - F.col("rare_idx")
    place = [F.get("place_window", start)["b"].alias("first"), F.get("place_window", start + F.col("n") - 1)["e"].alias("last")] if "place_window" in anchor.columns else []
    out = j.filter((F.col("n") == 1) | (start >= 0) & same).select(*key, *group, "term", begin.alias("begin"), (begin + F.col("n")).alias("end"), *place)
    out = by(out) if by else out
    return out.distinct() if lemma else out  # a token and its lemma may both lead to one class


def sentence_words(notes: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key..., sent_no (from 0), words: sentences and their words, natively. A sentence ends at . ! ? before white space and at line ends."""
    marked = F.regexp_replace(F.regexp_replace(F.col(text), "[\r\n]+", "\x01"), r"([.!?])[ \t\f]+", "$1\x01")
    parts = F.filter(F.transform(F.split(marked, "\x01"), plain_tokens), lambda t: F.size(t) > 0)
    return notes.select(*key, F.posexplode(parts).alias("sent_no", "words"))


def spans(notes: DataFrame, terms: DataFrame, exclude: list[str] | None = None, group: list[str] | None = None) -> DataFrame:
    """doc_id, sent_no, group..., term, begin, end: each span of a sentence that a class names, once."""
    words = plain_tokens(F.col("str"))
    index = sized(term_classes(terms, words, group))
    ok = F.transform("words", lambda w: ~w.isin(exclude)) if exclude else None
    sent = sentence_words(spread(notes.select("doc_id", "text")), ["doc_id"])
    return matches(anchors(sent, ["doc_id", "sent_no"], F.col("words"), reach_of(terms, words), None, ok), index, ["doc_id", "sent_no"], group)


def semantic(tui: Column) -> Column:
    """Semantic group of a TUI; the groups' order decides."""
    out = F.lit("unknown")
    for name, ids in reversed(R.SEMANTIC):
        out = F.when(tui.isin(ids), name).otherwise(out)
    return out


def concepts(rows: DataFrame) -> DataFrame:
    """cui, semantic: the groups that a concept belongs to, from vocabulary rows (cui, tui)."""
    return rows.select("cui", F.explode(tui_list(F.col("tui"))).alias("t")).select("cui", semantic(F.col("t")).alias("semantic")).distinct()


def merged_concepts(rows: DataFrame, order: list[str] | None = None, group: list[str] | None = None) -> DataFrame:
    """group..., cui, pref, tuis, codes (array of sab, code, ttys): a concept's vocabulary rows as one.

    ``pref`` is that of the first row by ``order`` (columns of ``rows``), else the least. A scheme may lack
    any column but the cui: what is absent counts as empty.
    """
    group = group or []
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    place = F.struct(*[F.col(c) for c in order or []], have("pref")) if order else F.struct(have("pref"))
    c = rows.select(*group, F.upper("cui").alias("cui"), F.upper(have("sab")).alias("sab"), have("code").alias("code"), F.upper(have("tty")).alias("tty"), have("pref").alias("pref"), place.alias("place"), tui_list(have("tui")).alias("tuis"))
    codes = c.filter("sab <> ''").groupBy(*group, "cui", "sab", "code").agg(F.sort_array(F.collect_set(F.when(F.col("tty") != "", F.col("tty")))).alias("ttys"))
    codes = codes.groupBy(*group, "cui").agg(F.sort_array(F.collect_list(F.struct("sab", "code", "ttys"))).alias("codes"))
    heads = c.groupBy(*group, "cui").agg(F.min_by("pref", "place").alias("pref"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("tuis")))).alias("tuis"))
    return heads.join(codes, [*group, "cui"], "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<struct<sab:string,code:string,ttys:array<string>>>")))


def class_groups(members: DataFrame, groups: DataFrame) -> DataFrame:
    """term, semantic, n_concepts, first_cui: the semantic groups of each class and how many of its concepts are in each.

    A concept without a group counts as unknown.
    """
    joined = members.join(groups, "cui", "left").withColumn("semantic", F.coalesce("semantic", F.lit("unknown")))
    return joined.groupBy("term", "semantic").agg(F.count(F.lit(1)).alias("n_concepts"), F.min("cui").alias("first_cui"))


def annotations(found: DataFrame, classes: DataFrame) -> DataFrame:
    """``found`` with a row for each semantic group of its class: semantic, n_concepts, first_cui."""
    return found.join(sized(classes), "term")


def has_semantic(semantics: Column, name: str) -> Column:
    """Whether a concept's array of semantic groups holds one."""
    return F.exists(semantics, lambda x: x == name)


def combined(first: Column, second: Column) -> Column:
    """Two arrays as one, each value once."""
    return F.array_union(F.coalesce(first, second), F.coalesce(second, first))


def longest(spans: DataFrame, key: list[str], where: Column | None = None) -> DataFrame:
    """Spans not strictly inside another of the same key: a sorted sweep, not a self-join. Those for which ``where`` doesn't hold all stay."""
    w = W.partitionBy(*key).orderBy(F.col("begin"), F.col("end").desc())
    reach, far = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)), F.min("begin").over(W.partitionBy(*key, "end"))
    # equal spans (of several classes) don't cover one another
    kept = spans.withColumns({"__reach": reach, "__far": far})
    free = F.col("__reach").isNull() | (F.col("end") > F.col("__reach")) | (F.col("end") == F.col("__reach")) & (F.col("begin") == F.col("__far"))
    return kept.filter(free if where is None else ~where | free).drop("__reach", "__far")
