"""Micro-batch runner for Structured Streaming."""
