from stormgrid.sources.grid import grid
from stormgrid.sources.payload import explode_parameters, read_payloads, rescue_payloads, with_payload
from stormgrid.sources.regions import read_regions, with_edges
from stormgrid.sources.tables import land_batch, read_csv, write_table

__all__ = [
    "explode_parameters", "grid", "land_batch", "read_csv", "read_payloads",
    "read_regions", "rescue_payloads", "with_edges", "write_table",
]
