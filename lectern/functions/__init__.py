"""Part of lectern: functions."""
