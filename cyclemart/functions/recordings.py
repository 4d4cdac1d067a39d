"""Electrode locations and recording identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region codes of known electrode locations.
REGION_CODES = {
    "hippocampus": "Hipp",
    "amygdala": "Amg",
    "dorsal_anterior_cingulate_cortex": "dACC",
    "pre_supplementary_motor_area": "preSMA",
    "ventral_medial_prefrontal_cortex": "vmPFC",
}


def hemisphere(location: Column) -> Column:
    return F.when(location.endswith("_left"), "L").when(location.endswith("_right"), "R").otherwise("")


def region_code(location: Column) -> Column:
    """Known code of a location without its side, else its words joined in CamelCase, else NA."""
    base = F.regexp_replace(location, "_(left|right)$", "")
    known = F.create_map(*[F.lit(x) for pair in REGION_CODES.items() for x in pair])
    camel = F.array_join(
        F.transform(F.split(base, "_"), lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2)))), ""
    )
    squeezed = F.nullif(F.regexp_replace(camel, r"[^\p{L}\p{N}]", ""), F.lit(""))
    return F.coalesce(F.element_at(known, base), squeezed, F.lit("NA"))


def subject_code(identifier: Column, subject_field: Column) -> Column:
    """Patient code ending the identifier, else the numbered subject field, else the identifier."""
    token = F.element_at(F.split(identifier, "_"), -1)
    return F.coalesce(
        F.when(F.upper(token).startswith("P"), token),
        F.when(subject_field != "", F.concat(F.lit("sub"), subject_field)),
        F.nullif(identifier, F.lit("")),
        F.lit("unknown"),
    )


def session_code(session_field: Column) -> Column:
    return F.coalesce(F.nullif(session_field, F.lit("")), F.lit("1"))


def epoch_bounds(onset_s: Column, start_s: Column, fs: float, from_s: float, to_s: float, n_samples: Column) -> tuple[Column, Column]:
    """First and one-past-last sample index of ``[onset + from_s, onset + to_s)``."""
    def edge(offset: float) -> Column:
        return F.ceil((onset_s + F.lit(float(offset)) - start_s) * F.lit(float(fs)) - F.lit(1e-9))

    return F.greatest(F.lit(0).cast("long"), edge(from_s)), F.least(n_samples.cast("long"), edge(to_s))
