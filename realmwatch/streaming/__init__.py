"""Live loads: micro-batch folding into the store, and native stateful slices."""
