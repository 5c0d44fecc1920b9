from comarca.sources.delimited import read_delimited, write_delimited
from comarca.sources.documents import (
    ATTRIBUTE_DOCUMENT,
    ATTRIBUTE_PATH,
    SLOTS,
    read_documents,
    read_elements,
)
from comarca.sources.scratch import scratch_path
from comarca.sources.stored import (
    current_version,
    read_partitioned,
    read_versioned,
    switch_version,
    write_partitioned,
    write_versioned,
)
from comarca.sources.tagged import ingest_tagged, source_tag

__all__ = [
    "ATTRIBUTE_DOCUMENT",
    "ATTRIBUTE_PATH",
    "SLOTS",
    "current_version",
    "ingest_tagged",
    "read_delimited",
    "read_documents",
    "read_elements",
    "read_partitioned",
    "read_versioned",
    "scratch_path",
    "source_tag",
    "switch_version",
    "write_delimited",
    "write_partitioned",
    "write_versioned",
]
