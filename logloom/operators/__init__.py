"""Data jobs: token classification and token tables, ABI catalog and
signature registry, registry-driven decoding, prices."""
