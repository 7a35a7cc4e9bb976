"""The registry must not depend on the corpus operators."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_corpus_operators():
    for path in [*ROOT.glob("stormledger/**/*.py"), *ROOT.glob("checks/*.py"), *ROOT.glob("tools/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert not re.search(r"^\s*(?:from|import) .*\bllm\b", path.read_text(), re.M), path
