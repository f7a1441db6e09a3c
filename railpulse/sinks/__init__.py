"""Writers: tables, partition replacement, compaction, messages, documents."""
