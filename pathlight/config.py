"""Parameters of the jobs, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SubjectRule:
    """Which ASNs are watched: none of the glue, and a known prefix count within bounds."""

    exclude_glue: bool = True
    min_prefixes: int = 1
    max_prefixes: int = 5000


@dataclass(frozen=True)
class DiffConfig:
    subjects: SubjectRule = field(default_factory=SubjectRule)
    footprint_relative: float = 0.25
    footprint_absolute: int = 5


@dataclass(frozen=True)
class SparseConfig:
    min_moves_per_pair_day: int = 2
    keep_new_adj: bool = False
    keep_upstream_converge: bool = False
    keep_footprint_step: bool = False


#: ASNs that lease addresses out.
LEASING = (834, 396998, 211585, 49999, 61138, 43260)

#: Transit, cloud and content networks that are context only.
GLUE = (
    16509, 14618, 7224, 8987, 9059, 15169, 36040, 396982, 43515, 19527, 36492, 16591,
    36039, 139190, 8075, 8068, 8069, 12076, 13335, 209242, 20940, 54113, 16625, 18717,
    20189, 174, 209, 286, 701, 1239, 1299, 2914, 3257, 3320, 3356, 3491, 6453, 6461, 6762,
    6830, 7018, 3561, 7922, 714, 32934, 63293, 54115, 13414, 2906,
)
