"""Offer sources: raw rows per source, and their mappings to the raw offer schema."""
