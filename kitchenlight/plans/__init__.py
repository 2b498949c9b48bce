"""The jobs: area filter, staging, warehouse, marts, geography, quality, serving."""
