import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.001"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with columns whose names operators use."""

    def build(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clash:
            for c in ("size", "fp", "block", "row", "score", "key", "z", "spans", "component_id", "hash", "label", "target", "mix_rank"):
                df = df.selectExpr("*", f"'x' as {c}")
        return df

    return build


#: Nulls, empty and white texts, ties, repeated rows, a very long text, text beyond ASCII.
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "the same few words here"), (5, "the same few words here"), (5, "the same few words here"), (None, "no id at all"), (None, None), (6, "é" * 3000), (7, "word " * 40_000), (8, "x" * 200_000), (-3, "Ünïcode — ok 😀 text"), (9, "a")]
