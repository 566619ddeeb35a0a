"""The published data products. Each is one lazy plan: frames and parameters in, frame out."""
