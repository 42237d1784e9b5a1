"""Daily booking and customer pipeline: stage, check, merge, publish."""
