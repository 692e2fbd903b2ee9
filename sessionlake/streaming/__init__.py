"""Streams of captured model calls: server-sent events, messages folded from them, ledgers, progress."""
