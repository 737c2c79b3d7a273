"""Part of lectern: streaming."""
