"""The library must not need its llm part."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_nothing_else_imports_llm():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"tidemark\.llm|from tidemark import llm", path.read_text()), path
