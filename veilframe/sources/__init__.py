"""Tables and configurations on storage."""

from veilframe.sources.configs import read_link_spec, read_policy, read_secret
from veilframe.sources.tables import (
    materialize,
    read_table,
    refused_records,
    scratch,
    stored,
    with_place,
    write_table,
)

__all__ = [
    "materialize",
    "read_link_spec",
    "read_policy",
    "read_secret",
    "read_table",
    "refused_records",
    "scratch",
    "stored",
    "with_place",
    "write_table",
]
