"""Sources: schema, ingest, the derived incidents view, synthetic rows."""

from blotter.sources.incidents import incidents, raw_incidents
from blotter.sources.ingest import profile, read_incident_csv, standardise, write_incident_csv
from blotter.sources.synth import synthetic_incidents

__all__ = [
    "incidents",
    "profile",
    "raw_incidents",
    "read_incident_csv",
    "standardise",
    "synthetic_incidents",
    "write_incident_csv",
]
