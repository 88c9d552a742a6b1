"""Declarations a caller hands to the operators: policies and link specs."""

from veilframe.plans.linkspec import LinkSpec
from veilframe.plans.policy import Condition, Policy, Treatment

__all__ = ["Condition", "LinkSpec", "Policy", "Treatment"]
