"""tierwise.streaming: incremental (streaming) bronze loads."""
