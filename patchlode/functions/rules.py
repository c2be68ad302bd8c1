"""Rule catalogue: untrusted inputs, dangerous calls, security measures, search keywords.

Rules are written as call shapes (see ``text.shape_regex``): a blank is optional white space,
``~`` required white space, ``*`` optional word characters, ``…`` anything on the line.
"""

from __future__ import annotations

from dataclasses import dataclass

from .text import ASSIGN, FLAGS, SPACE, WORD, shape_anchor, shape_regex


@dataclass(frozen=True)
class SourceRule:
    """``<variable> = <shape><tail>``, or an annotation followed by a parameter."""

    rule_id: str
    category: str
    type: str
    shape: str
    tail: str = ""
    kind: str = "assign"

    @property
    def anchor(self) -> str:
        return shape_anchor(self.shape)

    @property
    def regex(self) -> str:
        if self.kind == "annotation":
            return f"{FLAGS}{shape_regex(self.shape)}{SPACE}*"
        return f"{FLAGS}{ASSIGN}{shape_regex(self.shape)}{self.tail}"


@dataclass(frozen=True)
class SinkRule:
    rule_id: str
    vuln_type: str
    name: str
    shape: str

    @property
    def anchor(self) -> str:
        return shape_anchor(self.shape)

    @property
    def regex(self) -> str:
        return FLAGS + shape_regex(self.shape)


# ---- Fixed values: these must be as they are for results to agree -----------------------------

REQUEST_ACCESSORS = (
    "getParameter", "getParameterValues", "getParameterMap", "getHeader", "getHeaders",
    "getCookies", "getQueryString", "getRequestURI", "getPathInfo", "getServletPath",
    "getAttribute", "getInputStream", "getReader",
)
REQUEST_HELPERS = ("ServletRequestUtils.getStringParameter", "WebUtils.getParameter")
PARAMETER_ANNOTATIONS = (
    "PathParam", "QueryParam", "HeaderParam", "FormParam",
    "RequestParam", "PathVariable", "RequestHeader", "RequestBody",
)
# (category, type, shape, tail)
OTHER_SOURCES = (
    ("file", "newFile", "new~File (", rf"[^)]*{WORD}[^)]*\)"),
    ("file", "Paths.get", "Paths.get (", ""),
    ("file", "fileParam", "*request*.getParameter ( ",
     r"""["'](?:file|path|dir|name|filename|upload)["']"""),
    ("file", "fileHeader", "*request*.getHeader ( ",
     r"""["'](?:X-File|X-Path|X-Filename)["']"""),
    ("deserialization", "readObject", "….readObject (", ""),
    ("deserialization", "readObject", "ObjectInputStream….readObject (", ""),
    ("env", "getenv", "System.getenv (", ""),
    ("env", "getProperty", "System.getProperty (", ""),
    ("env", "args", "args [", ""),
    ("env", "getInitParameter", "….getInitParameter (", ""),
)
# CWE (upper case) -> source categories; any other CWE uses every category.
SOURCE_CATEGORIES = ("http", "file", "deserialization", "env")
CWE_SOURCE_CATEGORIES = {
    "CWE-79": ("http",),
    "CWE-89": ("http",),
    "CWE-22": ("http", "file"),
    "CWE-502": ("http", "deserialization"),
}
NOT_VARIABLES = ("null", "true", "false")
PROPAGATION_ROUNDS = 5
ANNOTATION_REACH = 100

# (vulnerability type, sink name, shape)
SINKS = (
    ("SQLi", "execute", ".execute ("),
    ("SQLi", "executeQuery", ".executeQuery ("),
    ("SQLi", "executeUpdate", ".executeUpdate ("),
    ("SQLi", "Statement.execute", "Statement ….execute"),
    ("SQLi", "createStatement", "createStatement ()"),
    ("XSS", "println", ".println ("),
    ("XSS", "print", ".print ("),
    ("XSS", "write", ".write ("),
    ("XSS", "append", ".append ("),
    ("XSS", "getWriter", "response.getWriter ()."),
    ("XSS", "out.print", "out.print"),
    ("XSS", "PrintWriter.print", "PrintWriter….print"),
    ("XSS", "setContentType", "response.setContentType ("),
    ("XSS", "document.write", "document.write ("),
    ("XSS", "innerHTML", "innerHTML ="),
    ("XSS", "outerHTML", "outerHTML ="),
    ("XSS", "html", ".html ("),
    ("PathTraversal", "new File", "new~File ("),
    ("PathTraversal", "FileInputStream", "FileInputStream ("),
    ("PathTraversal", "FileOutputStream", "FileOutputStream ("),
    ("PathTraversal", "Files.readAllBytes", "Files.readAllBytes ("),
    ("PathTraversal", "Files.readString", "Files.readString ("),
    ("PathTraversal", "Files.copy", "Files.copy ("),
    ("PathTraversal", "Files.move", "Files.move ("),
    ("PathTraversal", "Files.write", "Files.write ("),
    ("PathTraversal", "getCanonicalPath", ".getCanonicalPath ("),
    ("PathTraversal", "toPath", ".toPath ("),
    ("PathTraversal", "Paths.get", "Paths.get ("),
    ("PathTraversal", "getAbsolutePath", ".getAbsolutePath ("),
    ("PathTraversal", "getAbsoluteFile", ".getAbsoluteFile ("),
    ("CommandInjection", "Runtime.exec", "Runtime.getRuntime ().exec ("),
    ("CommandInjection", "ProcessBuilder", "ProcessBuilder ("),
    ("Deserialization", "readObject", ".readObject ("),
    ("Deserialization", "ObjectInputStream.readObject", "ObjectInputStream….readObject"),
)

SECURITY_MEASURES = {
    "PreparedStatement": (
        "PreparedStatement", "prepareStatement (", ".setString (", ".setInt (", ".setLong (",
        ".setBoolean (", ".setObject (",
    ),
    "escapeHtml": (
        "escapeHtml (", "StringEscapeUtils.escapeHtml", "Encode.forHtml",
        "ESAPI.encoder ().encodeForHTML", "HtmlUtils.htmlEscape",
        "OWASP.ESAPI.encoder().encodeForHTML", ".escapeHtml", "HtmlEscape", "XSSUtils.escape",
    ),
    "normalize": (
        "Paths.normalize (", ".toRealPath (", ".getCanonicalPath (", ".getCanonicalFile (",
        ".toPath ().normalize", ".normalize (",
    ),
    "pathValidation": (
        ".startsWith (", ".contains (", ".equals (", ".indexOf (", ".matches (",
        "PathValidator", "isValidPath", "isAllowedPath",
    ),
    "ObjectInputFilter": (
        "ObjectInputFilter", ".setObjectInputFilter (", "ObjectInputFilter.Config.createFilter",
    ),
    "validation": (
        "Pattern.compile", ".matches (", "StringUtils.isNotBlank", "StringUtils.isNotEmpty",
        "Validator.validate", "@Valid~", "@NotNull~", "@NotBlank~",
    ),
    "whitelist": ("whitelist", "allowlist", "isAllowed", "isWhitelisted"),
    "sanitize": ("sanitize (", "Sanitizer.", "clean ("),
}

# Search keywords. Source type -> keyword; a type not listed has none.
SOURCE_KEYWORDS = {
    "getParameter": "getParameter",
    "getParameterValues": "getParameter",
    "getParameterMap": "getParameter",
    "WebUtils.getParameter": "getParameter",
    "fileParam": "getParameter",
    "getHeader": "getHeader",
    "getHeaders": "getHeader",
    "fileHeader": "getHeader",
    "getRequestURI": "getRequestURI",
    "getQueryString": "getQueryString",
    "getPathInfo": "getPathInfo",
    "getServletPath": "getServletPath",
    "readObject": "readObject",
    "getProperty": "getProperty",
    "getenv": "getenv",
}
# Weakness -> keywords -> the sinks that give them; "" is for every other weakness.
SINK_KEYWORDS = {
    "CWE-79": {
        ("append",): ("append",),
        ("println", "response.getWriter"): (
            "println", "print", "write", "getWriter", "out.print", "PrintWriter.print",
        ),
        ("innerHTML",): ("innerHTML", "outerHTML"),
    },
    "CWE-22": {
        ("new File(",): (
            "new File", "FileInputStream", "FileOutputStream", "Files.readAllBytes",
            "Files.readString", "Files.copy", "Files.move", "Files.write", "getAbsoluteFile",
        ),
        ("Paths.get",): ("Paths.get",),
    },
    "": {
        ("Statement.execute",): (
            "execute", "executeQuery", "executeUpdate", "Statement.execute",
        ),
        ("println",): ("println", "print", "out.print", "PrintWriter.print"),
        ("Files.readAllBytes",): ("Files.readAllBytes", "Files.readString"),
        ("Runtime.exec",): ("Runtime.exec",),
        ("Paths.get",): ("Paths.get",),
        ("new File(",): (
            "new File", "FileInputStream", "FileOutputStream", "Files.copy", "Files.move",
            "Files.write", "getAbsoluteFile",
        ),
        ("readObject",): ("readObject", "ObjectInputStream.readObject"),
    },
}
# Weakness -> missing measure -> words that must not occur.
NOT_KEYWORDS = {
    "CWE-79": {"escapeHtml": ("escapeHtml", "StringEscapeUtils", "ESAPI")},
    "CWE-22": {
        "normalize": ("normalize", "getCanonicalPath"),
        "pathValidation": ("isValidPath", "PathValidator"),
    },
    "": {
        "PreparedStatement": ("PreparedStatement",),
        "escapeHtml": ("escapeHtml",),
        "normalize": ("normalize",),
    },
}

API_CLASSES = (
    "Files", "Paths", "Path", "Runtime", "ProcessBuilder", "URL", "URI", "File",
    "FileInputStream", "FileOutputStream", "BufferedReader", "PrintWriter", "StringBuilder",
    "StringBuffer",
    "HttpServletRequest", "HttpServletResponse", "ServletRequest", "ServletResponse",
    "HttpSession", "Cookie",
    "RequestParam", "PathVariable", "RequestHeader", "RequestBody",
    "PreparedStatement", "Statement", "Connection", "ResultSet",
    "StringEscapeUtils", "ESAPI", "ObjectInputFilter",
)
GENERIC_TYPE_NAMES = (
    "string", "object", "list", "map", "set", "array", "int", "long", "double", "float",
    "boolean", "char", "byte",
)

LANGUAGE_EXTENSIONS = {"java": "java", "javascript": "js", "python": "py", "typescript": "ts"}

# ---- End of fixed values ------------------------------------------------------------------------


def _source_rules() -> tuple[SourceRule, ...]:
    rows = [("http", name, f"*request*.{name} (", "", "assign") for name in REQUEST_ACCESSORS]
    rows += [("http", name, f"{name} (", "", "assign") for name in REQUEST_HELPERS]
    rows += [("http", name, f"@{name}", "", "annotation") for name in PARAMETER_ANNOTATIONS]
    rows += [(*row, "assign") for row in OTHER_SOURCES]
    return tuple(
        SourceRule(f"src{n:02d}", category, type_, shape, tail, kind)
        for n, (category, type_, shape, tail, kind) in enumerate(rows, 1)
    )


SOURCE_RULES = _source_rules()
SINK_RULES = tuple(SinkRule(f"snk{n:02d}", *row) for n, row in enumerate(SINKS, 1))
