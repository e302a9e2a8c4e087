from kiln.sources.tables import SCHEMAS, read_table, read_star
from kiln.sources import proxies

__all__ = ["SCHEMAS", "read_table", "read_star", "proxies"]
from kiln.sources.files import (write_table, read_csv, read_json, extend_history, union_sources,  # noqa: E402
                                contract_violations)
