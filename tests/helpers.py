import io
from contextlib import redirect_stdout


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def physical_plan(df, run=False):
    """The physical plan; with ``run``, the one adaptive execution settled on."""
    if run:
        df.collect()
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    text = out.getvalue()
    return text.split("== Initial Plan ==")[0] if run else text


def values(df, column):
    return [r[0] for r in df.select(column).collect()]
