"""Part of lectern: sources."""
