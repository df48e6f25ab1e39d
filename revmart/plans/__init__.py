"""Warehouse models as DataFrame functions: staging, snapshots, enrichment, marts, warehouse runs."""
