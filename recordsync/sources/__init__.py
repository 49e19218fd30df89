from .readers import read_table, read_jdbc, read_json_lines, read_documents, jdbc_options  # noqa: F401
from .standins import DomainTables  # noqa: F401
