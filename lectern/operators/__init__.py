"""Part of lectern: operators."""
