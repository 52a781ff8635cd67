"""Readers and writers for landed exports, stores and review sets."""
