"""Structured Streaming: score incoming readings with a rule or a fitted model."""
