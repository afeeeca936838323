"""All registered queries outside the optional subpackage."""

from parley.plans import q_audit, q_catalog, q_files, q_labels, q_manifest, q_media, q_release, q_state, q_structure

FLAGSHIP = "v21_action_grid"
QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _module in (q_state, q_structure, q_audit, q_labels, q_media, q_release, q_manifest, q_files, q_catalog):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
