"""litholake: PySpark-native analytics for wafer-inspection and design-geometry data.

Sub-packages
------------
functions   column-expression libraries (robust statistics, geometry, strings, frames, closed-form fits)
operators   DataFrame -> DataFrame operators
kernels     NumPy kernels that run inside Arrow/pandas functions (rasters, polygons)
sources     readers and writers (tables, batch files, annotations, GDSII streams)
plans       named queries over the test tables, each with its SQL counterpart where SQL can express it
streaming   Structured Streaming extension
llm         operators for text and model-data pipelines; nothing else imports it
"""

__version__ = "0.1.0"
