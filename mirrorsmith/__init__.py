"""mirrorsmith: metadata-driven table mirrors on Spark.

Rows arrive as pages of JSON whose shape is described by a metadata
document.  The package derives table schemas from that metadata, decodes
the JSON into typed columns, removes page-overlap duplicates, merges loads
into versioned snapshots, exposes nested line sections, checks keys and
constraints, and answers ordinary queries over the result.  Every step is a
DataFrame transformation; the driver only handles one table description
(a few hundred column rows at most) at a time.
"""

from mirrorsmith.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
