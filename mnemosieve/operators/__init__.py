"""Index, scoring, retrieval, candidates, events, instruments, identity and evaluation."""
