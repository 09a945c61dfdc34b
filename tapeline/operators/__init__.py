"""DataFrame transformations. Unless a docstring says otherwise they take batch and streams."""
