"""DataFrame in, lazy DataFrame out."""

from veilframe.operators.linkage import link, tokenise
from veilframe.operators.profiling import figures_of, merged, moments, profile, statistics_row
from veilframe.operators.treating import pseudonymize

__all__ = ["figures_of", "link", "merged", "moments", "profile", "pseudonymize", "statistics_row", "tokenise"]
