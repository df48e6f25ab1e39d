from __future__ import annotations

import pytest

from revmart.llm.common import apply_llm_confs

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def llm_confs(spark):
    apply_llm_confs(spark)


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text[, lang[, source]]) tuples."""
    def build(rows, extra=False):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] else 0) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        if extra:  # names the operators use inside
            for c in ("digest", "size", "token", "n", "node", "bin", "offset", "component_id", "score", "keep_id"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return build
