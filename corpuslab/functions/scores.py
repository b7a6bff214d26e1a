"""Decision scores of the repetition classifiers as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published coefficients (repetitions, sequence length, intercept).
LINEAR_SVM = (0.888846, 0.666538, -6.777051)
LINEAR_LOGISTIC = (1.0713804477, 0.7981359963, -9.1584997404)
# Bias, rep, len, rep^2, rep*len, len^2, intercept.
QUADRATIC = (
    -0.0005429170, 0.0380797988, 0.0280639033,
    0.2609198746, 0.3383034829, 0.1560897638, -15.5181124275,
)


def linear_score(reps: Column, length: Column, coefficients: tuple[float, float, float] = LINEAR_SVM) -> Column:
    a, b, c = coefficients
    return F.lit(a) * reps + F.lit(b) * length + F.lit(c)


def quadratic_score(reps: Column, length: Column) -> Column:
    bias, r, n, rr, rn, nn, c = QUADRATIC
    return (
        F.lit(bias) + F.lit(r) * reps + F.lit(n) * length + F.lit(rr) * reps * reps
        + F.lit(rn) * reps * length + F.lit(nn) * length * length + F.lit(c)
    )


def probability(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
