"""Repeated loads: new files once, or one time interval again."""
