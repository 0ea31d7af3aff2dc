"""Readers and cleaners for the movement log and the stock snapshots."""
