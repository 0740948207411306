"""python -m wardmill build-index CONFIGS DICTIONARIES OUT | annotate CONFIGS DICTIONARIES NOTES OUT

build-index writes the term index of every configuration of a folder, unless it is there for the same lines.
annotate writes the envelope of every ``*.txt`` note of a folder as JSON lines.
"""

from __future__ import annotations

import sys

from wardmill.operators import pipeline, responses
from wardmill.session import build_session
from wardmill.sources import load_configurations, read_notes, write_results


def main(args: list[str]) -> int:
    if len(args) < 4 or args[0] not in ("build-index", "annotate") or len(args) != {"build-index": 4, "annotate": 5}[args[0]]:
        print(__doc__, file=sys.stderr)
        return 2
    spark = build_session()
    configurations = load_configurations(args[1])
    looked = [c for c in configurations if c.pipeline == "default_clinical"]
    lines = pipeline.dictionary_lines(spark, args[2], looked) if looked else None
    if args[0] == "build-index":
        for c in looked:
            print(c.name, pipeline.build_index(spark, lines, c, args[3]).count())
        return 0
    done = pipeline.annotate_notes(read_notes(spark, args[3]), "doc_id", lines, configurations)
    write_results(responses.envelope(done, "doc_id"), args[4])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
