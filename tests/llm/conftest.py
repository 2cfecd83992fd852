import pytest

#: Names that operators use for columns of their own.
CLASHING = ("row", "node", "key", "doc", "spans", "_row", "_source", "_lang", "_topic", "_cut_text", "mass", "present", "component_id")


@pytest.fixture
def docs_of(spark):
    """Documents (doc_id, text) with extra columns, whose names operators use too."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in CLASHING)
        more = [f"x{c}" if n % 3 else None for n, c in enumerate(CLASHING)]
        full = [(i, t, "en" if n % 2 else None, "s", len(t) if t else 0, *more) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, schema)

    return make
