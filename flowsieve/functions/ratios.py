"""Ratios over counts; a zero denominator gives 0.0."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(part: Column | str, whole: Column | str) -> Column:
    return F.coalesce(F.try_divide(_c(part), _c(whole)), F.lit(0.0))


def accuracy(tn, fp, fn, tp) -> Column:
    tn, fp, fn, tp = map(_c, (tn, fp, fn, tp))
    return safe_ratio(tn + tp, tn + fp + fn + tp)


def precision(fp, tp) -> Column:
    fp, tp = _c(fp), _c(tp)
    return safe_ratio(tp, tp + fp)


def recall(fn, tp) -> Column:
    fn, tp = _c(fn), _c(tp)
    return safe_ratio(tp, tp + fn)


def f1(fp, fn, tp) -> Column:
    fp, fn, tp = _c(fp), _c(fn), _c(tp)
    return safe_ratio(2 * tp, 2 * tp + fp + fn)
