"""Readers and writers: FASTA, job requests, messages, site lists, inventories."""
