"""DataFrame -> DataFrame transforms, alike on batch and stream."""
