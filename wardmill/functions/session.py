"""The annotators as functions of a session, for SQL: Arrow-batched, with the models given once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wardmill.functions import tokens as tk
from wardmill.operators import attributes, tagging
from wardmill.operators.pipeline import Models


def register(spark: SparkSession, models: Models = Models()) -> None:
    """Registers ptb_tokens, term_tokens, lemma, drug_spans, lab_links, polarity. A null text gives null."""

    def over(f):
        """A function of one or two text columns, applied to a batch; equal arguments are worked out once."""

        def run(*columns):
            known: dict = {}
            keys = list(zip(*columns))
            for k in keys:
                if k not in known:
                    known[k] = f(*k) if all(isinstance(x, str) for x in k) else None
            return columns[0].__class__([known[k] for k in keys], dtype=object)

        return run

    def ptb(text):
        return [{"begin": t.begin, "end": t.end, "text": t.text, "kind": t.kind, "shape": t.shape} for t in tk.tokenize(text)]

    def drugs(text):
        return [{"kind": s.kind, "begin": s.begin, "end": s.end, "text": text[s.begin : s.end], "value": s.value} for s in attributes.drug_spans(tk.tokenize(text), models.intended)]

    def places(text, name):
        low, at, out = text.lower(), -1, []
        while name and (at := low.find(name.lower(), at + 1)) >= 0:
            out.append((at, at + len(name)))
        return out

    def labs(text, name):
        return [{k: r[k] for k in ("begin", "end", "value", "unit")} for r in attributes.link_labs(text, places(text, name), models.labs, units=models.units)]

    def polarity(text, name):
        tokens, found = tk.tokenize(text), places(text, name)
        return ("negative" if any(attributes.is_negative(tokens, *p) for p in found) else "positive") if found else None

    def base(form, tag):
        return tagging.lemma(form, tag, models.exceptions, models.rules, models.bases, models.abbreviations)

    one = {"ptb_tokens": (ptb, tk.TOKEN), "term_tokens": (tk.term_tokens, "array<string>"), "drug_spans": (drugs, "array<struct<kind:string,begin:int,end:int,text:string,value:string>>")}
    two = {"lemma": (base, "string"), "lab_links": (labs, "array<struct<begin:int,end:int,value:string,unit:string>>"), "polarity": (polarity, "string")}
    for name, (f, kind) in one.items():
        run = over(f)
        spark.udf.register(name, F.pandas_udf(lambda a, run=run: run(a), kind, F.PandasUDFType.SCALAR))
    for name, (f, kind) in two.items():
        run = over(f)
        spark.udf.register(name, F.pandas_udf(lambda a, b, run=run: run(a, b), kind, F.PandasUDFType.SCALAR))
