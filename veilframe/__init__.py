"""De-identification and record linkage of large tables on Spark."""

from veilframe.operators import figures_of, link, merged, moments, profile, pseudonymize, tokenise
from veilframe.plans import Condition, LinkSpec, Policy, Treatment
from veilframe.sources import (
    materialize,
    read_link_spec,
    read_policy,
    read_table,
    refused_records,
    scratch,
    stored,
    write_table,
)

__all__ = [
    "Condition",
    "LinkSpec",
    "Policy",
    "Treatment",
    "figures_of",
    "link",
    "materialize",
    "merged",
    "moments",
    "profile",
    "pseudonymize",
    "read_link_spec",
    "read_policy",
    "read_table",
    "refused_records",
    "scratch",
    "stored",
    "tokenise",
    "write_table",
]
