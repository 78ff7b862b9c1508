"""Column-level functions (hex words, integers, JSON edges, Keccak)."""
