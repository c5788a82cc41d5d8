"""Pure column functions (Column in -> Column out), usable in batch and streaming."""
