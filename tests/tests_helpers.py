from datetime import date, datetime
from decimal import Decimal


def d(text):
    return date.fromisoformat(text) if text else None


def ts(text):
    return datetime.fromisoformat(text)


def dec(text):
    return Decimal(text)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(str(v) for v in r))


def plan_text(df):
    """The physical plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()
