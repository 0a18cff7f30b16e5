"""Sources: message decoding, stream sources and warehouse tables."""

from dimweave.sources.messages import decode, message_text  # noqa: F401
from dimweave.sources.streams import open_files, open_topic  # noqa: F401
from dimweave.sources.tables import driver_table, read_jdbc, read_table  # noqa: F401
