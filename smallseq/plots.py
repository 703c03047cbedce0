"""Drawing of plot data. matplotlib is optional: without it the data tables are still written."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows that a plot may bring to the driver; plot data are aggregates far below it, and more raises.
MAX_ROWS = 200_000


def collected(df: DataFrame):
    pdf = df.limit(MAX_ROWS + 1).toPandas()
    if len(pdf) > MAX_ROWS:
        raise ValueError("too many points to draw")
    return pdf


def available() -> bool:
    try:
        import matplotlib  # noqa: F401
    except ImportError:
        return False
    return True


def _axes():
    import matplotlib

    matplotlib.use("agg")
    import matplotlib.pyplot as plt

    return plt.subplots()


def stacked_lengths(props: DataFrame, library: str, path: str) -> None:
    """Stacked bars of 5' bases by length."""
    pdf = collected(props.where(props["library"] == library)).sort_values("length")
    fig, ax = _axes()
    floor = 0
    for base in "ACGT":
        ax.bar(pdf["length"], pdf[base], bottom=floor, label=base)
        floor = floor + pdf[base]
    ax.legend()
    fig.savefig(path)


def proportion_bars(props: DataFrame, library: str, label: str, path: str) -> None:
    pdf = collected(props.where(props["library"] == library)).sort_values(label)
    fig, ax = _axes()
    ax.barh(pdf[label], pdf["proportion"])
    fig.savefig(path)


def scatter(points: DataFrame, path: str, x: str, y: str) -> None:
    """Log-log scatter; a zero is drawn at the lower limit."""
    pdf = collected(points)
    fig, ax = _axes()
    some = [v for v in [*pdf["x"], *pdf["y"]] if v > 0]
    low = min(some, default=1.0)
    ax.loglog(pdf["x"].clip(lower=low), pdf["y"].clip(lower=low), ".", base=2)
    ax.set(xlabel=x, ylabel=y)
    fig.savefig(path)
